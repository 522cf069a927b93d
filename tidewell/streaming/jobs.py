"""The incremental jobs as Structured Streaming queries.

Sinks that take part in exactly-once use ``foreachBatch`` with the batch number in the path: a batch that is run
again after a failure overwrites its own files and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.current import latest
from tidewell.plans.serving import merge_minutes, merge_user_stats, minute_rollup, user_stats
from tidewell.streaming import levels

BATCH = "batch_id"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """A stream over arriving files; a fixed schema, so nothing is inferred from the first file."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def message_stream(spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka") -> DataFrame:
    """Message values as text (column ``value``) from any source that has one: ``kafka``, or ``text`` files."""
    reader = spark.readStream.format(fmt)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_messages(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines -> columns; a line that does not parse keeps its text in ``_bad`` and has NULL columns."""
    with_bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.select("value", parsed.alias("_r")).select(
        *[F.col("_r")[f.name].alias(f.name) for f in schema.fields],
        F.when(F.col("_r").isNull(), F.col("value")).otherwise(F.col("_r._bad")).alias("_bad"),
    )


def run_once(writer, checkpoint: str, timeout_seconds: int | None = None) -> StreamingQuery:
    """Take everything that is there, wait, and stop; the checkpoint makes the next call go on from here.

    A backlog takes the time it takes: there is no limit unless one is given.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_seconds} s")
    if query.exception() is not None:
        raise query.exception()
    return query


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """What the batches wrote, without the batch number."""
    return spark.read.schema(schema).format(fmt).load(f"{path}/{BATCH}=*")


RUN_LOG = "batch_id BIGINT, job STRING, read_rows BIGINT, finished_at TIMESTAMP"


def logged(write: Callable[[DataFrame, int], None], path: str, job: str) -> Callable[[DataFrame, int], None]:
    """``write`` for every batch, and after it one row of the run log under the batch's number: a batch that is run
    again replaces its row. Read with :func:`run_log`."""

    def run(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            write(cached, batch_id)
            row = cached.agg(F.count("*").alias("read_rows")).select(
                F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(job).alias("job"), "read_rows", F.current_timestamp().alias("finished_at")
            )
            row.write.mode("overwrite").parquet(f"{path}/log_of={batch_id}")
        finally:
            cached.unpersist()

    return run


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch, of all runs."""
    return spark.read.schema(RUN_LOG).parquet(f"{path}/log_of=*")


def many_sinks(outputs: Mapping[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """One input, several outputs (path -> transform), the input read once per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            for path, transform in outputs.items():
                write_batch(transform(cached), path, batch_id)
        finally:
            cached.unpersist()

    return write


def ingest(stream: DataFrame, good_path: str, bad_path: str):
    """Good rows to one table, the text of bad lines to a quarantine table."""
    return stream.writeStream.foreachBatch(
        many_sinks(
            {
                good_path: lambda b: b.where(F.col("_bad").isNull()).drop("_bad"),
                bad_path: lambda b: b.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("record")),
            }
        )
    )


def raw_and_derived(stream: DataFrame, raw_path: str, derived: Mapping[str, Callable[[DataFrame], DataFrame]]):
    """The raw rows and what is derived from them, in one pass over each batch."""
    return stream.writeStream.foreachBatch(many_sinks({raw_path: lambda b: b, **derived}))


def rollups(stream: DataFrame, minute_path: str, user_path: str, fan_out: int = levels.FAN_OUT):
    """Partial rollups per batch, merged by levels as batches come in (see :mod:`tidewell.streaming.levels`); late rows
    need no rewrite. Read with ``levels.read`` and merge."""

    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            levels.add(minute_rollup(cached), batch_id, minute_path, merge_minutes, fan_out)
            levels.add(user_stats(cached), batch_id, user_path, merge_user_stats, fan_out)
        finally:
            cached.unpersist()

    return stream.writeStream.foreachBatch(write)


def masked(stream: DataFrame, path: str, mask: Callable[[DataFrame], DataFrame]):
    """Mask inside the stream: raw values never reach a file."""
    return stream.transform(mask).writeStream.foreachBatch(lambda b, n: write_batch(b, path, n))


def append_changes(stream: DataFrame, path: str, keys: Sequence[str], version: str):
    """Follow a change log: per batch the newest version of each key is appended; read with ``latest``."""
    return stream.writeStream.foreachBatch(lambda b, n: write_batch(latest(b, keys, version), path, n))


def window_parts(stream: DataFrame, at: str, width: str, dims: Sequence[str], value: str, path: str):
    """Event-time windows as partial counts per batch. No state and no watermark: a row that comes late, however late,
    is a part of its window in a later batch, and :func:`merged_windows` adds the parts up."""

    def part(batch: DataFrame) -> DataFrame:
        grouped = batch.groupBy(F.window(at, width).alias("w"), *dims)
        return grouped.agg(F.count("*").alias("events"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *dims, "events", "total")

    return stream.writeStream.foreachBatch(lambda b, n: write_batch(part(b), path, n))


def merged_windows(parts: DataFrame, dims: Sequence[str]) -> DataFrame:
    return parts.groupBy("window_start", *dims).agg(F.sum("events").alias("events"), F.sum("total").alias("total"))


def counts_by(stream: DataFrame, column: str, path: str, log: str | None = None, job: str = "counts"):
    """Counts per value and batch, added up by :func:`merged_counts`; with ``log`` one run-log row per batch."""
    write = lambda b, n: write_batch(b.groupBy(column).agg(F.count("*").alias("count")), path, n)
    return stream.writeStream.foreachBatch(logged(write, log, job) if log else write)


def merged_counts(parts: DataFrame, column: str) -> DataFrame:
    return parts.groupBy(column).agg(F.sum("count").alias("count"))
