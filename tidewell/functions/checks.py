"""Assertions over small aggregate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.workspace import scratch


class CheckFailed(AssertionError):
    """A check over a finished aggregate did not hold."""


def require(condition: Column, message: str) -> Column:
    """TRUE, or the query fails with the message.  NULL counts as not held."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.lit(message)).cast("boolean")
    )


def check_none(failures: DataFrame, message: str, show: int = 50) -> None:
    """Raise when there is any failing row: all failures are stored as a table in the shared folder, and the message has
    their number, the place of that table and the first ``show`` of them."""
    spark = failures.sparkSession
    folder = scratch(spark, "failures")
    failures.write.parquet(folder)
    kept = spark.read.schema(failures.schema).parquet(folder)
    lines = [" | ".join(str(v) for v in row) for row in kept.take(show)]
    if lines:
        raise CheckFailed("\n  ".join([f"{message}: {kept.count()} failures, all of them in {folder}", *lines]))
