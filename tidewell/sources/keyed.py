"""JSON lines in keyed storage: batches of files go in once, however often they are sent; the newest row of a key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.current import latest

BUCKETS = 32


def bucket_of(keys: Sequence[Column | str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def load_lines(spark: SparkSession, paths: Sequence[str], schema: T.StructType, root: str, keys: Sequence[str], batch: str, buckets: int = BUCKETS) -> None:
    """Load JSON-lines files as one batch; a batch that is loaded again replaces itself.

    The rows lie in folders by batch and bucket of the key. Lines that do not parse, and rows without a key, go to
    ``root/rejected`` with their text; nothing is dropped.
    """
    with_text = T.StructType([*schema.fields, T.StructField("_line", T.StringType())])
    lines = spark.read.text(list(paths))
    parsed = lines.select(F.col("value"), F.from_json("value", with_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}).alias("r"))
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col("r")[k].isNull()
    bad = F.col("r").isNull() | F.col("r._line").isNotNull() | F.coalesce(keyless, F.lit(True))
    parsed.where(bad).select("value").write.mode("overwrite").text(f"{root}/rejected/batch={batch}")
    rows = parsed.where(~bad).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    # The hint brings a bucket's rows together and lets a large bucket be split.
    placed = rows.withColumn("bucket", bucket_of(keys, buckets)).hint("rebalance", "bucket")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{root}/rows/batch={batch}")


def newest(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key over all batches: the greatest ``version``; of equal ones that of the last batch by name."""
    placed = T.StructType([*schema.fields, T.StructField("batch", T.StringType()), T.StructField("bucket", T.IntegerType())])
    rows = spark.read.option("basePath", f"{root}/rows").schema(placed).parquet(f"{root}/rows")
    return latest(rows, list(keys), [*version, "batch"]).select(*schema.names)


def of_key(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], version: Sequence[str], values: Sequence, buckets: int = BUCKETS) -> DataFrame:
    """The newest row of one key; only its bucket is read."""
    placed = T.StructType([*schema.fields, T.StructField("batch", T.StringType()), T.StructField("bucket", T.IntegerType())])
    rows = spark.read.option("basePath", f"{root}/rows").schema(placed).parquet(f"{root}/rows")
    typed = [F.lit(v).cast(schema[k].dataType) for k, v in zip(keys, values)]
    own = rows.where(F.col("bucket") == bucket_of(typed, buckets))
    for k, v in zip(keys, typed):
        own = own.where(F.col(k) == v)
    return latest(own, list(keys), [*version, "batch"]).select(*schema.names)
