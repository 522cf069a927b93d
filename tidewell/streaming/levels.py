"""Partial results of a stream in levels: few folders to read however many batches there were.

Each batch adds one folder. When a level holds ``FAN_OUT`` folders they are merged into one of the next level, so after
n batches at most FAN_OUT - 1 folders per level and log n levels are live. What is live stands in a manifest of one row,
which is written whole after the folders and takes turns between two places: a reader sees the state before a batch or
after it. A batch that is run again finds itself in the manifest and is skipped; one that was lost on the way, also in
the middle of a merge, writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN_OUT = 4

_MANIFEST = "state BIGINT, live ARRAY<STRUCT<name: STRING, level: INT, first: BIGINT, last: BIGINT>>"

Merge = Callable[[DataFrame], DataFrame]


def _states(spark: SparkSession, root: str) -> list:
    """The rows of the two places that there are."""
    found = []
    for place in (0, 1):
        try:
            found += spark.read.schema(_MANIFEST).json(f"{root}/manifest/place={place}").collect()
        except Exception as missing:  # noqa: BLE001 - a place that was not written yet, or is being replaced
            if not any(w in str(missing) for w in ("PATH_NOT_FOUND", "FILE_NOT_EXIST", "FileNotFound")):
                raise
    return found


def live(spark: SparkSession, root: str) -> tuple[int, list]:
    """(state number, live folders), oldest first; (-1, []) before the first batch."""
    states = _states(spark, root)
    if not states:
        return -1, []
    newest = max(states, key=lambda r: r.state)
    return newest.state, sorted(newest.live, key=lambda p: p.first)


def _publish(spark: SparkSession, root: str, state: int, parts: list[tuple]) -> None:
    row = spark.createDataFrame([(state, parts)], _MANIFEST)
    row.coalesce(1).write.mode("overwrite").json(f"{root}/manifest/place={state % 2}")


def _due(parts: list[tuple], fan_out: int) -> list[tuple]:
    """The oldest full row of folders of one level, lowest level first."""
    for level in sorted({p[1] for p in parts}):
        row = [p for p in parts if p[1] == level]
        if len(row) >= fan_out:
            return row[:fan_out]
    return []


def add(batch: DataFrame, batch_id: int, root: str, merge: Merge, fan_out: int = FAN_OUT) -> None:
    """Add a batch's partial rows; ``merge`` makes fewer rows of the same columns from partial rows of any number of
    batches, and must be associative. A batch that is in already is passed over."""
    spark = batch.sparkSession
    state, now = live(spark, root)
    if any(p.last >= batch_id for p in now):
        return
    own = (f"level=0/batches={batch_id}-{batch_id}", 0, batch_id, batch_id)
    batch.write.mode("overwrite").parquet(f"{root}/{own[0]}")
    parts = [tuple(p) for p in now] + [own]
    while due := _due(parts, fan_out):
        level, first, last = due[0][1] + 1, due[0][2], due[-1][3]
        name = f"level={level}/batches={first}-{last}"
        merged = merge(spark.read.schema(batch.schema).parquet(*[f"{root}/{p[0]}" for p in due]))
        merged.select(*batch.columns).write.mode("overwrite").parquet(f"{root}/{name}")
        parts = [p for p in parts if p not in due] + [(name, level, first, last)]
    _publish(spark, root, state + 1, parts)


def read(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The partial rows of all batches, from the live folders only; merge them once more to get totals."""
    _, now = live(spark, root)
    if not now:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{p.name}" for p in now])


def replaced(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """Paths of the files that no reader of the current state needs, for the storage's own clean-up."""
    _, now = live(spark, root)
    every = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(f"{root}/level=*")
    paths = every.select(F.col("_metadata.file_path").alias("file")).distinct()
    needed = F.array(*[F.lit(p.name) for p in now]).cast("array<string>")
    return paths.where(~F.exists(needed, lambda n: F.contains("file", F.concat(F.lit("/"), n, F.lit("/")))))
