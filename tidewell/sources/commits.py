"""Tables whose commits carry their own metadata, so that the next increment does not read what is already there.

A commit writes data files, then statistics of each file, then one row that makes it count. Per file: rows, least and
greatest arrival time, and a Bloom filter of the row keys, in blocks of bits. The newest arrival time is read from the
statistics. An increment asks the filters which files may hold one of the rows on offer, and only those files are
opened for the anti-join; a filter never misses a key, so the result is that of an anti-join with the whole table.

``root/data/commit=<id>`` holds the rows, ``root/files``, ``root/blooms`` the statistics, ``root/log`` the commits.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.current import EPOCH

#: Bits of one block of a filter, bits set for a key, bits provided for each key of a file.
BLOCK_BITS, KEY_BITS, BITS_PER_KEY = 1 << 15, 6, 12

_LOG = "commit string, committed_at timestamp"
_BLOOMS = "commit string, file string, block int, bits binary"


def _files_schema(arrived_type: str) -> str:
    return f"commit string, file string, rows long, blocks int, first_at {arrived_type}, last_at {arrived_type}"


def _block(key_hash: Column, blocks: Column) -> Column:
    """Block of a key in a filter of so many blocks."""
    return F.pmod(F.shiftrightunsigned(key_hash, 20), blocks).cast("int")


def _bits(keys: Sequence[str]) -> Column:
    """Places of a key's bits inside its block: multiples of an odd step from a start."""
    start, step = F.xxhash64(F.lit(1), *keys), F.xxhash64(F.lit(2), *keys).bitwiseOR(F.lit(1))
    low = lambda c: c.bitwiseAND(F.lit(BLOCK_BITS - 1))  # noqa: E731 - small factors: products stay in a long
    return F.array_distinct(F.array(*[low(low(start) + F.lit(i) * low(step)) for i in range(KEY_BITS)]))


def commit(df: DataFrame, root: str, keys: Sequence[str], arrived: str, commit_id: str | None = None) -> str:
    """Append the rows as one commit. A commit that is run again under its number replaces what it wrote; one that
    fails on the way has no row in the log and is not seen. An empty commit is one without files."""
    spark, name = df.sparkSession, commit_id or uuid.uuid4().hex[:16]
    df.write.mode("overwrite").parquet(f"{root}/data/commit={name}")
    written = spark.read.schema(df.schema).parquet(f"{root}/data/commit={name}").withColumn("file", F.col("_metadata.file_path"))
    blocks = F.ceil(F.col("rows") * BITS_PER_KEY / BLOCK_BITS).cast("int")
    files = written.groupBy("file").agg(F.count("*").alias("rows"), F.min(arrived).alias("first_at"), F.max(arrived).alias("last_at"))
    files = files.select("file", "rows", blocks.alias("blocks"), "first_at", "last_at")
    files.write.mode("overwrite").parquet(f"{root}/files/commit={name}")
    sizes = spark.read.schema(files.schema).parquet(f"{root}/files/commit={name}").select("file", "blocks")
    hashed = written.select("file", F.xxhash64(*keys).alias("h"), _bits(keys).alias("b")).join(sizes, "file")
    # Bits of different tasks meet as bitmaps: at most one per file, block and task crosses the network.
    filled = hashed.select("file", _block(F.col("h"), F.col("blocks")).alias("block"), F.explode("b").alias("bit"))
    filled.groupBy("file", "block").agg(F.bitmap_construct_agg("bit").alias("bits")).write.mode("overwrite").parquet(f"{root}/blooms/commit={name}")
    done = spark.range(1).select(F.lit(name).alias("commit"), F.current_timestamp().alias("committed_at"))
    done.coalesce(1).write.mode("overwrite").json(f"{root}/log/of={name}")
    return name


def _committed(spark: SparkSession, root: str) -> DataFrame:
    """The commits that count; a folder without its row in the log is not one."""
    return spark.read.schema(_LOG).json(f"{root}/log/of=*").select("commit").distinct()


def create(spark: SparkSession, root: str) -> None:
    """An empty table: a commit of nothing."""
    spark.range(1).select(F.lit("").alias("commit"), F.current_timestamp().alias("committed_at")).coalesce(1).write.json(f"{root}/log/of=created")


def file_statistics(spark: SparkSession, root: str, arrived_type: str) -> DataFrame:
    """One row per data file of the table."""
    if not _names(spark, root):
        return spark.createDataFrame([], _files_schema(arrived_type))
    every = spark.read.option("basePath", f"{root}/files").schema(_files_schema(arrived_type)).parquet(f"{root}/files")
    return every.join(_committed(spark, root), "commit", "left_semi")


def _names(spark: SparkSession, root: str) -> bool:
    return not _committed(spark, root).where("commit <> ''").isEmpty()


def high_water_mark(spark: SparkSession, root: str, arrived_type: str, floor: str = EPOCH):
    """The newest arrival time of the table, from its statistics; the floor for an empty one."""
    newest = file_statistics(spark, root, arrived_type).agg(F.max("last_at").alias("m"))
    return newest.select(F.coalesce("m", F.lit(floor).cast(arrived_type)).alias("m")).first().m


def read(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows of the table."""
    if not _names(spark, root):
        return spark.createDataFrame([], schema)
    rows = spark.read.option("basePath", f"{root}/data").schema(schema).parquet(f"{root}/data/commit=*").withColumn("commit", F.regexp_extract("_metadata.file_path", "/commit=([^/]+)/", 1))
    return rows.join(_committed(spark, root), "commit", "left_semi").drop("commit")


def files_that_may_hold(rows: DataFrame, root: str, keys: Sequence[str], arrived: str, arrived_type: str, low=None) -> list[str]:
    """Paths of the files whose filter and time range let one of the rows be in them.

    ``low`` leaves out files that end before it. Every row asks each file in whose time range it falls for one block,
    so the join is by file group (number of blocks) and block. The answer is a list of files to open, as any scan has.
    """
    spark = rows.sparkSession
    files = file_statistics(spark, root, arrived_type)
    if low is not None:
        files = files.where(F.col("last_at") >= F.lit(low))
    sizes = [r.blocks for r in files.select("blocks").distinct().collect()]
    if not sizes:
        return []
    blooms = spark.read.option("basePath", f"{root}/blooms").schema(_BLOOMS).parquet(f"{root}/blooms")
    filters = blooms.join(files.select("commit", "file", "blocks", "first_at", "last_at"), ["commit", "file"])
    # A row has one block for each size of filter that occurs; sizes are few, as files are written up to a limit.
    asked = rows.select(F.col(arrived).alias("_at"), F.xxhash64(*keys).alias("_h"), _bits(keys).alias("_b"))
    asked = asked.select("_at", "_b", "_h", F.explode(F.array(*[F.lit(s) for s in sorted(sizes)])).alias("blocks"))
    asked = asked.withColumn("block", _block(F.col("_h"), F.col("blocks")))
    near = filters.join(asked, ["blocks", "block"]).where(F.col("_at").between(F.col("first_at"), F.col("last_at")))
    # Byte b / 8 of a bitmap, bit b % 8 from the right.
    byte = lambda b: F.conv(F.hex(F.substring(F.col("bits"), (b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = near.where(F.forall("_b", lambda b: F.getbit(byte(b), (b % 8).cast("int")) == 1))
    return [r.file for r in there.select("file").distinct().collect()]


def increment(source: DataFrame, root: str, keys: Sequence[str], arrived: str, overlap: str = "1 minute") -> DataFrame:
    """Rows of the source that the table does not hold, from ``overlap`` before its newest arrival time on.

    The rows are those of :func:`tidewell.operators.current.increment`; but the mark comes from the statistics, and
    of the table only files are read that end after the start of the overlap and may hold a row on offer.
    Equal keys are taken to have equal arrival times, as versions of a row do.
    """
    spark, kind = source.sparkSession, source.schema[arrived].dataType
    mark = high_water_mark(spark, root, kind.simpleString())
    low = spark.range(1).select((F.lit(mark).cast(kind) - F.expr(f"INTERVAL {overlap}")).alias("low")).first().low
    fresh = source.where(F.col(arrived) >= F.lit(low).cast(kind))
    return missing(fresh, root, keys, arrived, low)


def missing(rows: DataFrame, root: str, keys: Sequence[str], arrived: str, low=None) -> DataFrame:
    """The rows whose key is in no file of the table; only files that may hold one are read."""
    spark = rows.sparkSession
    paths = files_that_may_hold(rows, root, keys, arrived, rows.schema[arrived].dataType.simpleString(), low)
    if not paths:
        return rows
    held = spark.read.schema(rows.schema).parquet(*paths)
    return rows.join(held.select(*keys), list(keys), "left_anti")


def increment_with_keys(
    source: DataFrame, root: str, pending: DataFrame, known_keys: DataFrame, key_column: str, keys: Sequence[str], arrived: str, overlap: str = "1 minute"
) -> tuple[DataFrame, DataFrame]:
    """(ready, pending) as :func:`tidewell.operators.current.increment_with_keys` gives them, against a table of commits.

    Rows that waited may lie anywhere in time; of the table only files whose range and filter let them be there are read.
    """
    waiting = missing(pending.select(*source.columns), root, keys, arrived)
    offered = increment(source, root, keys, arrived, overlap).unionByName(waiting).dropDuplicates(list(keys))
    entries = known_keys.select(key_column).distinct()
    return offered.join(entries, key_column, "left_semi"), offered.join(entries, key_column, "left_anti")
