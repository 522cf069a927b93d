"""Exact dedup by content sort.

Texts are equal when identical after lower-casing A-Z. A row's sort key is the first ``HEAD`` bytes of the
normalised text, then the SHA-256 of all of it, then its id: equal texts have equal keys, so the sort places
them next to each other, and a key stays short however long the text is. Spark samples splitters of that key,
range-partitions the rows and sorts each range externally. The id in the key lets a large group of copies
spread over several ranges.

One pass over each sorted range compares whole neighbouring texts and numbers the runs of equal ones. A run
may go on in the next range; only the first and the last run of a range can, so these few are chained by
comparing the texts at the borders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import partitions, stored, tune

#: Bytes of the text in the sort key; sampled splitters are never longer than this and a digest.
HEAD = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def normalise(text: str | None) -> bytes:
    return (text or "").encode("utf-8").translate(_LOWER)


def _keys(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, digests = [], []
            for t in batch.column(text).to_pylist():
                body = normalise(t)
                heads.append(body[:HEAD])
                digests.append(hashlib.sha256(body).digest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.binary()), pa.array(digests, pa.binary())],
                [*batch.schema.names, "_head", "_digest"],
            )

    return run


def _runs(text: str, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run_no, before, held = -1, None, None

        def row(batch: pa.RecordBatch, at: slice, run_of: list[int], last: list[bool], edge: list[bytes | None]):
            cut = batch.slice(at.start, at.stop - at.start)
            return pa.RecordBatch.from_arrays(
                [
                    *(cut.column(c) for c in carry),
                    cut.column("_row_id"),
                    pa.array([d.hex() for d in cut.column("_digest").to_pylist()], pa.string()),
                    pa.array([part] * len(cut), pa.int32()),
                    pa.array(run_of, pa.int64()),
                    pa.array(last, pa.bool_()),
                    pa.array(edge, pa.binary()),
                ],
                [*carry, "_row_id", "_sha", "_part", "_run", "_last", "_edge"],
            )

        for batch in batches:
            if not len(batch):
                continue
            numbers, starts = [], []
            for t in batch.column(text).to_pylist():
                body = normalise(t)
                starts.append(before is None or body != before)
                run_no += starts[-1]
                numbers.append(run_no)
                before = body
            if held:  # its successor is known now
                old, number, edge = held
                yield row(old, slice(0, 1), [number], [starts[0]], [edge])
            n = len(batch)
            first = [normalise(batch.column(text)[0].as_py()) if held is None else None]
            if n > 1:
                yield row(batch, slice(0, n - 1), numbers[:-1], starts[1:], first + [None] * (n - 2))
            # A copy of the last row alone, so that the batch can be freed.
            tail = pa.RecordBatch.from_arrays(
                [pa.concat_arrays([c.slice(n - 1, 1)]) for c in batch.columns], batch.schema.names
            )
            held = tail, numbers[-1], first[0] if n == 1 else None
        if held:
            yield row(held[0], slice(0, 1), [held[1]], [True], [before])

    return run


def _sorted_rows(docs: DataFrame, text: str, id: str, carry: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sorted rows, their runs and the chains of runs, under names of our own (columns of the input can't clash):
    ``_c0``.. are the columns in ``carry``."""
    spark = tune(docs.sparkSession)
    names = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(
        *[docs[f"`{c}`"].alias(n) for c, n in zip(carry, names)],
        docs[f"`{id}`"].alias("_row_id"),
        docs[f"`{text}`"].cast("string").alias("_text"),
    )
    key_fields = [T.StructField("_head", T.BinaryType()), T.StructField("_digest", T.BinaryType())]
    keyed = rows.mapInArrow(_keys("_text"), T.StructType([*rows.schema.fields, *key_fields]))
    out = T.StructType(
        [
            *rows.schema.fields[:-1],
            T.StructField("_sha", T.StringType()),
            T.StructField("_part", T.IntegerType()),
            T.StructField("_run", T.LongType()),
            T.StructField("_last", T.BooleanType()),
            T.StructField("_edge", T.BinaryType()),
        ]
    )
    key = ["_head", "_digest", "_row_id"]
    in_order = keyed.repartitionByRange(partitions(spark), *key).sortWithinPartitions(*key)
    marked = stored(in_order.mapInArrow(_runs("_text", names), out), "content-sort")
    runs = marked.groupBy("_part", "_run").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_row_id").alias("_max"), F.count("_edge").alias("_edges")
    )
    # Stored, so that Spark knows how few rows they are when it plans the join.
    return marked.drop("_edge"), runs, stored(_chains(marked, runs), "chains")


def mark_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the largest id is kept, exactly one also when ids repeat; a null id counts as
    smallest. A null text counts as empty. Other columns are not read. No rows give no rows.
    """
    marked, runs, chains = _sorted_rows(docs, text, id, [])
    return (
        marked.join(runs.select("_part", "_run", "_n", "_max"), ["_part", "_run"])
        .join(chains, ["_part", "_run"], "left")
        .select(
            F.col("_row_id").alias(id),
            F.when(F.col("_chain_n").isNull(), F.col("_max")).otherwise(F.col("_chain_max")).alias("keep_id"),
            F.coalesce("_chain_n", "_n").alias("group_size"),
            (F.col("_last") & F.coalesce("_final", F.lit(True))).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def _chains(marked: DataFrame, runs: DataFrame) -> DataFrame:
    """The first and the last run of each range with the totals of the chain of equal runs they are part of.

    There are at most two such runs a range, so the windows without a partition below see a few rows per
    partition of the sort, not rows of the data; texts take no part in them.
    """
    edges = marked.where(F.col("_edge").isNotNull())
    # A range of one row has that row's text as its first and its last edge.
    ends = edges.groupBy("_part").agg(
        F.min_by("_edge", F.struct("_run", F.col("_last").cast("int"))).alias("_first_text"),
        F.max_by("_edge", F.struct("_run", F.col("_last").cast("int"))).alias("_last_text"),
        F.max("_run").alias("_top"),
    )
    in_order = Window.orderBy("_part")
    following = ends.select("_part").withColumn("_before", F.lag("_part").over(in_order))
    linked = (
        following.join(ends.select("_part", "_first_text"), "_part")
        .join(ends.select(F.col("_part").alias("_before"), "_last_text"), "_before")
        .where(F.col("_first_text") == F.col("_last_text"))
        .select("_part", F.lit(0).cast("long").alias("_run"), F.lit(True).alias("_linked"))
    )
    nodes = runs.where("_edges > 0").select("_part", "_run", "_n", "_max").join(linked, ["_part", "_run"], "left")
    ordered = Window.orderBy("_part", "_run")
    numbered = nodes.withColumn(
        "_chain", F.sum(F.when(F.col("_linked"), 0).otherwise(1)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    total = numbered.groupBy("_chain").agg(
        F.sum("_n").alias("_chain_n"), F.max("_max").alias("_chain_max"), F.max(F.struct("_part", "_run")).alias("_end")
    )
    return numbered.join(total, "_chain").select(
        "_part", "_run", "_chain_n", "_chain_max", (F.struct("_part", "_run") == F.col("_end")).alias("_final")
    )


def drop_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rule of ``mark_copies``. The texts move once, in the
    sort; which rows stay needs only the chains."""
    marked, _, chains = _sorted_rows(docs, text, id, docs.columns)
    kept = marked.where("_last").join(chains.select("_part", "_run", "_final"), ["_part", "_run"], "left").where(F.coalesce("_final", F.lit(True)))
    return kept.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
