"""Substring dedup by content-defined chunking.

A gear rolling hash over the last ``WINDOW`` bytes cuts a text where its value says so, which depends on the bytes
around the cut only: an insertion moves the cuts next to it and no others, so a passage that two documents share is
cut alike in both. Chunks are variable; a digest that occurs in different documents marks a shared chunk, and a run
of neighbouring shared chunks of ``WORDS`` words or more is a repeated passage. The document with the smallest
id keeps a chunk, the others' copies can be cut out.

Digests are counted with a combine before the shuffle; the chunks are then joined to the shared digests, a join whose
large partitions Spark splits. A chunk seen in one document only goes no further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import stored, tune

WINDOW, SEED = 16, 7
#: A chunk's bytes: at least LEAST, 16 more on average, at most MOST.
LEAST, MOST = 16, 256
_CUT_SHIFT, _CUT_MASK = 12, 15
#: Words that a run of shared chunks must have; a passage loses up to a window and a chunk at either end.
WORDS = 20

_GEAR = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)
STEP = 1 << 21


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Places after which the gear hash cuts, given the bytes of one text; never inside a character."""
    if not len(data):
        return np.zeros(0, np.int64)
    h = _GEAR[data]
    span = 1
    while span < WINDOW:  # h covers span bytes; two halves side by side cover twice as many
        older = np.zeros_like(h)
        older[span:] = h[:-span]
        h = h + (older << np.uint32(span))
        span *= 2
    cut = ((h >> np.uint32(_CUT_SHIFT)) & np.uint32(_CUT_MASK)) == 0
    cut[:-1] &= (data[1:] & 0xC0) != 0x80
    return np.flatnonzero(cut) + 1


def boundaries(raw: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    data = np.frombuffer(raw, np.uint8)
    n = len(data)
    places: list[int] = []
    for a in range(0, n, STEP):  # pieces that begin a window early, so that the hash is the same
        early = max(0, a - WINDOW + 1)
        found = cut_candidates(data[early : min(n, a + STEP) + 1]) + early
        places += found[(found > a) & (found <= min(n, a + STEP))].tolist()
    ends, last = [], 0
    for c in [*places, n]:
        while c - last > MOST:
            last += MOST
            while (raw[last] & 0xC0) == 0x80:
                last -= 1
            ends.append(last)
        if c - last >= LEAST or c == n:
            if c > last:
                ends.append(c)
            last = c
    return ends


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def chunk_rows(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(doc, seq, start, bytes, words, digest) of every chunk of every text with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            for doc, t in zip(b.column("doc").to_pylist(), b.column("t").to_pylist()):
                raw = (t or "").encode("utf-8")
                if not raw:
                    continue
                ends = boundaries(raw)
                starts = [0, *ends[:-1]]
                space = _IS_SPACE[np.frombuffer(raw, np.uint8)]
                begins = ~space
                begins[1:] &= space[:-1]
                before = np.append(0, np.cumsum(begins))
                s, e = np.array(starts), np.array(ends)
                hashes = np.array([digest(raw[x:y]) for x, y in zip(starts, ends)], np.uint64).view(np.int64)
                for column, values in zip(columns, (np.full(len(ends), doc), np.arange(len(ends)), s, e - s, before[e] - before[s], hashes)):
                    column.append(values)
            if columns[0]:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k.to_pandas_dtype())) for c, k in zip(columns, kinds)], names)

    names = ["doc", "seq", "start", "bytes", "words", "digest"]
    slim = docs.select(docs[f"`{id}`"].cast("long").alias("doc"), docs[f"`{text}`"].cast("string").alias("t")).where("doc IS NOT NULL")
    return slim.mapInArrow(run, "doc long, seq int, start long, bytes int, words int, digest long")


def shared_runs(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """Rows (doc, run, start, stop, n_words, keeper, copies): passages of chunks that other documents have too; places
    in bytes, ``copies`` the (start, stop) of those chunks that a document with a smaller id keeps."""
    spark = tune(docs.sparkSession)
    rows = stored(chunk_rows(docs, text, id), "chunks")
    seen = rows.groupBy("digest").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last")).where("keeper <> last").select("digest", "keeper")
    # A document's places are distinct; rows that repeat a document repeat them.
    shared = rows.join(seen, "digest").select("doc", "seq", "start", "bytes", "words", "keeper").distinct()
    within = Window.partitionBy("doc").orderBy("seq", "start")
    numbered = shared.withColumn("run", F.col("seq") - F.row_number().over(within))
    stop = F.col("start") + F.col("bytes")
    copy = F.when(F.col("keeper") != F.col("doc"), F.struct("start", stop.alias("stop")))
    return (
        numbered.groupBy("doc", "run")
        .agg(
            F.min("start").alias("start"), F.max(stop).alias("stop"), F.sum("words").alias("n_words"), F.min("keeper").alias("keeper"),
            F.array_sort(F.collect_list(copy)).alias("copies"),
        )
        .where(F.col("n_words") >= words)
    )


def repeated_passages(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """One row per repeated passage of a document: its id, ``start`` and ``stop`` (bytes of the UTF-8 text), ``n_words``,
    ``keep_id`` (the smallest id that has a part of it) and ``removed`` (whether this document loses a part of it).

    Rows that share an id count as one document: what they share with each other only is not repeated. A row without
    an id, an empty or a null text have no passages. No rows give no rows.
    """
    found = shared_runs(docs, text, id, words)
    return found.select(
        F.col("doc").alias(id), "start", "stop", F.col("n_words").cast("long").alias("n_words"), F.col("keeper").alias("keep_id"), (F.size("copies") > 0).alias("removed")
    )


def remove_repeats(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """``docs`` with the copies of repeated passages cut out of its texts; all columns stay."""
    cuts = (
        shared_runs(docs, text, id, words).where(F.size("copies") > 0).select("doc", F.explode("copies").alias("c"))
        .groupBy("doc").agg(F.array_sort(F.collect_list("c")).alias("c"))
        .select(F.col("doc").alias("_of"), F.col("c.start").alias("_a"), F.col("c.stop").alias("_b"))
    )
    names = docs.columns
    rows = docs.select(*[docs[f"`{c}`"].alias(f"_c{i}") for i, c in enumerate(names)])
    own, t = f"_c{names.index(id)}", names.index(text)
    joined = rows.join(stored(cuts, "cuts"), F.col(own).cast("long") == F.col("_of"), "left").drop("_of")
    schema = T.StructType([*docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for value, starts, stops in zip(b.column(t).to_pylist(), b.column("_a").to_pylist(), b.column("_b").to_pylist()):
                if value is not None and starts:
                    raw, kept, at = value.encode("utf-8"), [], 0
                    for s, e in zip(starts, stops):
                        kept.append(raw[at:s])
                        at = max(at, e)
                    value = b"".join([*kept, raw[at:]]).decode("utf-8", "ignore")
                out.append(value)
            columns = b.columns[: len(names)]
            columns[t] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, schema)
