"""Loading a partitioned source by day, late rows of loaded days included.

Beside the target lies a ledger of what each day was when it was loaded: files, bytes and newest change of the source's
folder, and a digest of its rows (number and sum of hashes, which no order of rows changes). A day whose files are as
they were is not read. One whose files differ is digested, and only if the digest differs is it written again, whole:
rows that came late, were corrected or taken away end up as in the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources import lake
from tidewell.workspace import stored

_FILES = ("files", "bytes", "changed_at")
_DIGEST = ("rows", "hash_sum")


def _ledger_schema(day: str, kind: str) -> str:
    return f"`{day}` {kind}, files bigint, bytes bigint, changed_at timestamp, rows bigint, hash_sum decimal(38,0), load bigint"


def folder_state(source: DataFrame, day: str) -> DataFrame:
    """Files, bytes and newest change per day; reads no column of the rows."""
    files = source.select(day, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"), F.col("_metadata.file_modification_time").alias("m"))
    per_file = files.groupBy(day, "f").agg(F.max("s").alias("s"), F.max("m").alias("m"))
    return per_file.groupBy(day).agg(F.count("*").alias("files"), F.sum("s").alias("bytes"), F.max("m").alias("changed_at"))


def day_digests(rows: DataFrame, day: str) -> DataFrame:
    """Number of rows and sum of their hashes per day, over all columns by name. Maps have no hash: see ``to_json``."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns) if c != day]), {"ignoreNullFields": "false"})
    return rows.groupBy(day).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(whole).cast("decimal(38,0)")).alias("hash_sum"))


def loaded_days(spark: SparkSession, ledger: str, day: str, kind: str) -> DataFrame:
    """The ledger's newest row of each day; empty before the first load."""
    try:
        rows = spark.read.schema(_ledger_schema(day, kind)).parquet(f"{ledger}/load=*")
    except Exception as missing:  # noqa: BLE001 - only a missing path means that nothing was loaded
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], _ledger_schema(day, kind))
    columns = [c for c in rows.columns if c != day]
    return rows.groupBy(day).agg(F.max_by(F.struct(*columns), "load").alias("_n")).select(day, *[F.col("_n")[c].alias(c) for c in columns])


def reconcile(source: DataFrame, target: str, ledger: str, load: int, day: str = lake.DAY, fmt: str = "parquet") -> DataFrame:
    """Bring the target to the state of the source and return the days written: (day, rows, hash_sum, was_loaded).

    ``source`` is a scan of a table partitioned by ``day``. ``load`` numbers the run: one that failed is run again
    under its number. Days that the source no longer has stay in the target. The ledger is written after the rows, so
    a day lost in between is taken again.
    """
    spark, kind = source.sparkSession, source.schema[day].dataType.simpleString()
    known = loaded_days(spark, ledger, day, kind).where(F.col("load") < load)
    state = folder_state(source, day)
    same_files = stored(state.join(known.select(day, *_FILES), [day, *_FILES], "left_anti"), "changed-days")
    changed = source.join(same_files.select(day), day, "left_semi")
    digests = stored(day_digests(changed, day).join(same_files, day), "day-digests")
    differing = digests.join(known.select(day, *_DIGEST), [day, *_DIGEST], "left_anti")
    written = stored(differing.join(known.select(day, F.lit(True).alias("was_loaded")), day, "left"), "differing-days")
    if not written.isEmpty():
        # The list of days prunes the partitions of the source: the days of one load, as folders to open.
        wanted = [r[0] for r in written.select(day).collect()]
        lake.write_days(source.where(F.col(day).isin(wanted)), target, fmt, day)
    entry = digests.select(day, *_FILES, *_DIGEST, F.lit(load).cast("bigint").alias("load"))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/load={load}")
    return written.select(day, *_DIGEST, F.coalesce("was_loaded", F.lit(False)).alias("was_loaded"))
