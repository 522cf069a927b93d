"""Running values over sorted rows without one task per key: blocks of rows, a scan of block summaries, a second pass.

The rows are range-partitioned by key and order with a hash of the row as the last tie-breaker, so a block is a
range of about as many rows as any other, whether it holds many keys, part of one, or one instant of a burst. Within a
block a window does the work; what goes on from block to block is one summary row per key and block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.workspace import stored

BLOCK, TIE = "_block", "_tie"


def in_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """The rows with the number of their block, stored: every later step sees the same blocks.

    ``order`` sorts ascending, nulls first. There are as many blocks as shuffle partitions unless a number is given.
    """
    spark = df.sparkSession
    count = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(TIE, F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    spread = tied.repartitionByRange(count, *by, *order, TIE).withColumn(BLOCK, F.spark_partition_id())
    return stored(spread, "scan-blocks")


def _inside(by: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*by, BLOCK).orderBy(*order, TIE)


def _with_summary(rows: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows beside the summary of their key and block; keys may be null."""
    renamed = summary.select(*[F.col(c).alias(f"_s_{c}") for c in (*by, BLOCK)], *[c for c in summary.columns if c not in (*by, BLOCK)])
    same = [rows[c].eqNullSafe(renamed[f"_s_{c}"]) for c in (*by, BLOCK)]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return rows.join(renamed, condition, "left").drop(*[f"_s_{c}" for c in (*by, BLOCK)])


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, blocks: int | None = None) -> DataFrame:
    """``row_number`` from 1 within ``by``; ties of ``order`` are numbered by a hash of the row."""
    rows = in_blocks(df, by, order, blocks)
    per_block = stored(rows.groupBy(*by, BLOCK).agg(F.count("*").alias("_n")), "scan-sums")
    before = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = rows.withColumn(name, F.row_number().over(_inside(by, order)))
    return _with_summary(local, offsets, by).withColumn(name, (F.col(name) + F.col("_before")).cast("bigint")).select(*df.columns, name)


def carried(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, blocks: int | None = None) -> DataFrame:
    """The last non-null ``value`` at or before each row within ``by``."""
    rows = in_blocks(df.withColumn("_value", value), by, order, blocks)
    place = F.when(F.col("_value").isNotNull(), F.struct(*order, TIE))
    per_block = stored(rows.groupBy(*by, BLOCK).agg(F.max_by("_value", place).alias("_last")), "scan-lasts")
    before = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    local = rows.withColumn("_local", F.last("_value", ignorenulls=True).over(_inside(by, order)))
    return _with_summary(local, carry, by).withColumn(name, F.coalesce("_local", "_carry")).select(*df.columns, name)


def following(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, blocks: int | None = None) -> DataFrame:
    """``value`` of the next row within ``by``; null for the last."""
    rows = in_blocks(df, by, order, blocks)
    first = F.min_by(F.struct(F.col(value).alias("v")), F.struct(*order, TIE)).alias("_first")
    per_block = stored(rows.groupBy(*by, BLOCK).agg(first), "scan-firsts")
    later = per_block.withColumn("_next", F.lead("_first").over(Window.partitionBy(*by).orderBy(BLOCK))).drop("_first")
    local = rows.withColumn("_local", F.lead(F.struct(F.col(value).alias("v"))).over(_inside(by, order)))
    return _with_summary(local, later, by).withColumn(name, F.coalesce("_local", "_next")["v"]).select(*df.columns, name)
