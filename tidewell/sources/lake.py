"""Partitioned lake tables: scan, prune, describe, inventory, overwrite, staged publication."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.json_text import let

DAY = "dt"


def scan_lake(
    spark: SparkSession,
    path: str,
    fmt: str = "orc",
    first_day: str | None = None,
    last_day: str | None = None,
    schema: T.StructType | str | None = None,
    day: str = DAY,
) -> DataFrame:
    """A table laid out as ``dt=YYYY-MM-DD`` directories.

    The day range is a filter on the partition column, so other days' files are never opened.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if first_day is not None:
        df = df.where(F.col(day) >= F.lit(first_day).cast(df.schema[day].dataType))
    if last_day is not None:
        df = df.where(F.col(day) <= F.lit(last_day).cast(df.schema[day].dataType))
    return df


def describe(df: DataFrame) -> DataFrame:
    """Columns and types of a file set as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def file_inventory(df: DataFrame, day: str | None = DAY) -> DataFrame:
    """Files, bytes and rows per partition.  Rows of a file are counted before the file is, so this is a count per
    file followed by a sum, with no list of paths anywhere."""
    groups = [day] if day else []
    per_file = df.groupBy(
        *groups, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("rows"))
    return per_file.groupBy(*groups).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows")
    )


def write_days(
    df: DataFrame, path: str, fmt: str = "orc", day: str = DAY, sort: Sequence[str] = (), rows_per_file: int = 20_000_000
) -> None:
    """Write by day; only the days present in ``df`` are replaced.

    The rebalance hint brings the rows of a day together and lets AQE split a day that is larger than the advisory
    partition size, so a day with a third of all rows is written by many tasks and a small one by few.  Each task sorts
    its rows for min/max skipping.
    """
    spread = df.hint("rebalance", day)
    if sort:
        spread = spread.sortWithinPartitions(day, *sort)
    compression = {"orc": "zlib"}.get(fmt, "zstd")
    (
        spread.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(day)
        .save(path)
    )


def append_days(df: DataFrame, path: str, fmt: str = "orc", day: str = DAY) -> None:
    df.write.format(fmt).mode("append").partitionBy(day).save(path)


def export_sorted(
    df: DataFrame, path: str, sort_key: str | None, rows_per_file: int = 5_000_000, bloom: Sequence[str] = ()
) -> None:
    """Parquet export: range-partitioned and sorted by the key, zstd, bounded files, bloom filters for lookups.

    Range partitioning on the key plus a hash of the row's JSON, which every column type has, keeps one very frequent key
    from becoming one task.
    """
    out = df
    if sort_key:
        out = df.repartitionByRange(F.col(sort_key), F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).sortWithinPartitions(sort_key)
    writer = out.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


#: Bits per column of a clustering key: ranks among 2^RANK_BITS quantiles.
RANK_BITS = 8


def _rank_of(df: DataFrame, column: str, bounds: list) -> Column:
    """Number of bounds at or below the value, by binary search in a constant array; nulls come first."""
    value, steps = _number(df, column), F.array(*[F.lit(float(b)) for b in bounds]).cast("array<double>")
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(RANK_BITS))])

    def half(at: Column, k: Column) -> Column:
        return at + F.when(F.coalesce(F.get(steps, at + k - F.lit(1)) <= value, F.lit(False)), k).otherwise(F.lit(0))

    return F.aggregate(halves, F.lit(0), half)


def cluster_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Z-order of the columns' ranks: neighbours in the key are near in every column.

    A rank is the place among 256 quantiles, so the columns' units and skew do not matter; dates and times count by
    their number of days or seconds. The quantiles are 255 values a column, from one aggregate over the whole table.
    """
    bounds = df.agg(*[F.percentile_approx(_number(df, c), [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)], 10_000).alias(c) for c in columns]).first()
    def woven(ranks: Column) -> Column:
        key = F.lit(0).cast("bigint")
        for n in range(len(columns)):
            for bit in range(RANK_BITS):
                one = F.shiftright(F.get(ranks, F.lit(n)), bit).bitwiseAND(F.lit(1)).cast("bigint")
                key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + n))
        return key

    return let(F.array(*[_rank_of(df, c, bounds[c] or []) for c in columns]), woven)


def _number(df: DataFrame, column: str) -> Column:
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    # Text by its first six bytes: their order is the text's.
    return F.conv(F.rpad(F.substring(F.hex(F.encode(c.cast("string"), "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("double")


def export_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Parquet export in which a filter on any of the columns, or on several, skips files and row groups.

    Range partitioning on the Z-order key plus a hash of the row keeps one frequent key from becoming one task.
    """
    spread = df.withColumn("_z", cluster_key(df, columns))
    tie = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    parts = spread.repartitionByRange(files, "_z", tie) if files else spread.repartitionByRange("_z", tie)
    parts.sortWithinPartitions("_z").drop("_z").write.mode("overwrite").option("compression", "zstd").parquet(path)


# --- staged publication --------------------------------------------------------------------------------------

_MANIFEST = "version string, published_at timestamp, withdrawn boolean"


def publish(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Write a whole new version next to the old ones, then make it current by one small append to the manifest.

    A reader sees either the version before or the complete new one.  A failed write leaves no manifest row.
    """
    version = uuid.uuid4().hex[:16]
    df.write.format(fmt).mode("errorifexists").save(f"{root}/data/version={version}")
    _announce(df.sparkSession, root, version, withdrawn=False)
    return version


def withdraw(spark: SparkSession, root: str) -> None:
    """Make the table empty for readers, after a failed check of newer input."""
    _announce(spark, root, "", withdrawn=True)


def _announce(spark: SparkSession, root: str, version: str, withdrawn: bool) -> None:
    row = spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("published_at"), F.lit(withdrawn).alias("withdrawn")
    )
    row.coalesce(1).write.mode("append").json(f"{root}/manifest")


def published(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    """The current version, or None when it was withdrawn."""
    newest = (
        spark.read.schema(_MANIFEST).json(f"{root}/manifest")
        .agg(F.max_by(F.struct("version", "withdrawn"), "published_at").alias("m"))
        .first()
        .m
    )
    if newest is None or newest.withdrawn:
        return None
    return spark.read.format(fmt).load(f"{root}/data/version={newest.version}")

