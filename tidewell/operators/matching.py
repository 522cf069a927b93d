"""Joins that need more than an equality: default fills, either-key membership, containment, intervals.

None of them is a product of two tables.  Where the question is not an equality it is turned into one (a time
bucket, a text fingerprint) with an exact check afterwards, so Spark can hash-partition both sides and
its skew handling can split a hot partition.  No side is broadcast by hint: the size check is Spark's own
(``autoBroadcastJoinThreshold``, measured again at run time under AQE).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.scan import carried, following
from tidewell.workspace import stored


def left_join_filled(left: DataFrame, right: DataFrame, on: Sequence[str], fills: Mapping[str, object]) -> DataFrame:
    """Left join whose unmatched right columns take a default instead of NULL, right after the join."""
    joined = left.join(right, list(on), "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.lit(fills[c])).alias(c) if c in fills else F.col(c) for c in joined.columns]
    )


def semi_on_either(df: DataFrame, columns: Sequence[str], ids: DataFrame, id_column: str) -> DataFrame:
    """Rows where any of ``columns`` is one of the ids.

    An OR condition would leave Spark only a nested loop, so there is one equality join per column against
    distinct ids (no row can be multiplied).
    """
    out, hit = df, F.lit(False)
    for i, c in enumerate(columns):
        mark = ids.select(F.col(id_column).alias(f"_id{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        out = out.join(mark, out[c] == F.col(f"_id{i}"), "left")
        hit = hit | F.coalesce(F.col(f"_hit{i}"), F.lit(False))
    return out.where(hit).select(*[out[c] for c in df.columns])


def not_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Composite-key ``NOT IN`` as an anti join."""
    return df.join(other.select(*on), list(on), "left_anti")


def lookup(
    df: DataFrame, entries: DataFrame, on: Sequence[str], defaults: Mapping[str, Column], flag: str | None = None
) -> DataFrame:
    """Dictionary lookup with get-or-default and, optionally, a has-entry flag column."""
    marked = entries.withColumn("_has", F.lit(True))
    joined = df.join(marked, list(on), "left")
    columns = [
        F.when(F.col("_has"), F.col(c)).otherwise(defaults[c]).alias(c) if c in defaults else F.col(c)
        for c in joined.columns
        if c != "_has"
    ]
    if flag:
        columns.append(F.coalesce("_has", F.lit(False)).alias(flag))
    return joined.select(*columns)


def compare_with_expected(actual: DataFrame, expected: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Counts over a full join: matched, only on one side, and per field how many agree."""
    want = expected.select(*keys, *[F.col(f).alias(f"_want_{f}") for f in fields], F.lit(1).alias("_e"))
    have = actual.select(*keys, *fields, F.lit(1).alias("_a"))
    joined = have.join(want, list(keys), "full_outer")
    both = F.col("_a").isNotNull() & F.col("_e").isNotNull()
    return joined.agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("_e").isNull()).alias("unexpected"),
        F.count_if(F.col("_a").isNull()).alias("missing"),
        *[F.count_if(both & F.col(f).eqNullSafe(F.col(f"_want_{f}"))).alias(f"{f}_ok") for f in fields],
    )


# --- interval attribution --------------------------------------------------------------------------------


def attribute_to_marks(
    events: DataFrame, marks: DataFrame, event_time: str, mark_time: str, mark_name: str, by: Sequence[str] = (), blocks: int | None = None
) -> DataFrame:
    """Add the mark whose [start, next start) holds the event; events before the first mark are dropped.

    ``by`` are equality columns both sides share (for instance a user).  Marks must have distinct times within them.
    Events and marks are merged in blocks of about equal numbers of rows (see :mod:`tidewell.operators.scan`), so neither
    one user's events nor those of one instant have to be in one task.
    """
    by, named = list(by), F.struct(F.col("_at"), F.col("_name"))
    mk = marks.select(*by, F.col(mark_time).alias("_at"), F.col(mark_name).alias("_name"), F.lit(0).alias("_side"))
    kind = mk.schema["_name"].dataType
    ev = events.withColumn("_at", F.col(event_time)).withColumn("_name", F.lit(None).cast(kind)).withColumn("_side", F.lit(1))
    # At the same instant the mark comes first: an interval includes its start.
    both = ev.unionByName(mk, allowMissingColumns=True)
    found = carried(both, by, ["_at", "_side"], F.when(F.col("_side") == 0, named), "_m", blocks)
    kept = found.where((F.col("_side") == 1) & F.col("_m").isNotNull())
    return kept.select(*events.columns, F.col("_m._name").alias(mark_name), F.col("_m._at").alias(mark_time))


def mark_ends(marks: DataFrame, mark_time: str, by: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Each mark with the start of the next one as its end (open for the last)."""
    return following(marks, by, [mark_time], mark_time, "ends_at", blocks)


# --- containment -----------------------------------------------------------------------------------------

# Key length classes: (shortest key in bytes, gram bytes, grams per window).  Any text of at least
# gram + window - 1 bytes shares its window minima with every text that contains it.
_CLASSES = ((31, 16, 16), (16, 8, 9), (8, 6, 3))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    out = np.zeros(len(data) - gram + 1, dtype=np.uint64)
    for j in range(gram):
        out = out * np.uint64(0x100000001B3) + data[j : j + len(out)].astype(np.uint64) + np.uint64(1)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _packed_grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Grams of at most seven bytes as whole numbers: nothing is hashed, equal numbers are equal texts."""
    if len(data) < gram:
        return data[:0]
    out = np.zeros(len(data) - gram + 1, dtype=np.uint64)
    for j in range(gram):
        out = out * np.uint64(256) + data[j : j + len(out)].astype(np.uint64)
    return np.unique(out)


def _window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    if len(hashes) < window:
        return hashes[:0]
    return np.unique(np.lib.stride_tricks.sliding_window_view(hashes, window).min(axis=1))


def _anchors(text: bytes, classes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(class, hash) pairs of a text, as two arrays.  A class below 8 is the byte length of very short keys."""
    data = np.frombuffer(text, dtype=np.uint8)
    kinds, values = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for kind in classes:
        if kind >= 8:
            _, gram, window = next(c for c in _CLASSES if c[0] == kind)
            found = _window_minima(_gram_hashes(data, gram), window) if len(data) >= gram else data[:0]
        else:
            found = _packed_grams(data, kind)
        found = found.astype(np.int64)
        kinds.append(np.full(len(found), kind, np.int32))
        values.append(found)
    return np.concatenate(kinds), np.concatenate(values)


#: Bits of the filter of key anchors per anchor, and at most: 16 MB. A fuller filter lets more through to the exact join.
_FILTER_BITS, _FILTER_MOST = 16, 1 << 27


def _anchor_filter(key_anchors: DataFrame) -> np.ndarray:
    """A bitmap of the anchors that keys have, put together by tasks in words of 64 bits."""
    wanted = _FILTER_BITS * max(1, key_anchors.count())
    bits = min(_FILTER_MOST, max(1 << 12, 1 << (wanted - 1).bit_length()))
    at = F.col("_anchor").bitwiseAND(F.lit(bits - 1))
    words = key_anchors.select(F.shiftright(at, 6).alias("w"), F.expr("shiftleft(CAST(1 AS BIGINT), CAST(_anchor & 63 AS INT))").alias("b"))
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[found["w"].to_numpy()] = found["b"].to_numpy()
    return out.view(np.uint64)


def _passing(values: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    v = values.view(np.uint64)
    word = (v & np.uint64(64 * len(bitmap) - 1)) >> np.uint64(6)
    return ((bitmap[word.astype(np.int64)] >> (v & np.uint64(63))) & np.uint64(1)).astype(bool)


def _anchor_rows(
    df: DataFrame, id_column: str, text_column: str, classes: Sequence[int], own_class: bool, bitmap: np.ndarray | None = None
) -> DataFrame:
    """Distinct anchors per row; with ``own_class`` only those of the row's own length class, with ``bitmap`` only those
    that the filter lets through."""
    classes = list(classes)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)  # None, or at most 16 MB

    def packed(ids: pa.Array, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        rows = np.concatenate([np.full(len(k), position, np.int64) for position, k, _ in parts])
        kinds, values = (np.concatenate([part[i] for part in parts]) for i in (1, 2))
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows)), pa.array(kinds), pa.array(values)], names=[id_column, "_class", "_anchor"]
        )

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            parts, size = [], 0
            for position, text in enumerate(batch.column(1)):
                raw = text.as_py().encode("utf-8")
                k, v = _anchors(raw, [_class_of(len(raw))] if own_class else classes)
                if shared.value is not None:
                    keep = _passing(v, shared.value)
                    k, v = k[keep], v[keep]
                parts.append((position, k, v))
                size += len(k)
                # Long texts have many anchors: hand them on before a batch of them fills the memory.
                if size > 500_000:
                    yield packed(batch.column(0), parts)
                    parts, size = [], 0
            if parts:
                yield packed(batch.column(0), parts)

    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, text_column).mapInArrow(batches, f"`{id_column}` {kind}, _class int, _anchor bigint")


def _class_of(length: int) -> int:
    for shortest, _, _ in _CLASSES:
        if length >= shortest:
            return shortest
    return length


def _candidates(texts: DataFrame, text_id: str, text: str, keys: DataFrame, key_id: str, key: str):
    """Lower-cased texts and keys; (text id, key, class) of texts that share the rarest anchor of a key; and
    (key, class, anchor, number of texts with it).

    The texts are fingerprinted once: only anchors that a key may have leave their batch, and what is left is stored and
    read for the counts and for the candidates.
    """
    lowered = texts.select(text_id, F.lower(text).alias("_text")).where(F.length("_text") > 0)
    wanted = keys.select(key_id, F.lower(key).alias("_key")).where(F.length("_key") > 0)
    unique = wanted.select("_key").distinct()
    # The labels of all classes there are; a class no key has costs nothing, its anchors pass no filter.
    classes = sorted({*range(1, 8), *(c[0] for c in _CLASSES)})
    key_anchors = stored(_anchor_rows(unique, "_key", "_key", classes, own_class=True), "key-anchors")
    present = {r[0] for r in key_anchors.groupBy("_class").count().collect()}  # at most ten
    found = _anchor_rows(lowered, text_id, "_text", [c for c in classes if c in present], False, _anchor_filter(key_anchors))
    shared = stored(found.join(key_anchors.select("_class", "_anchor").distinct(), ["_class", "_anchor"], "left_semi"), "shared-anchors")
    common = shared.groupBy("_class", "_anchor").agg(F.count("*").alias("_n"))
    rarest = (
        key_anchors.join(common, ["_class", "_anchor"], "left")
        .groupBy("_key", "_class")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), F.col("_anchor"))).alias("_m"))
        .select("_key", "_class", "_m._anchor", "_m._n")
    )
    return lowered, wanted, shared, rarest


def _long_hits(lowered: DataFrame, text_id: str, shared: DataFrame, rarest: DataFrame) -> DataFrame:
    """(text id, key) of keys of eight bytes or more, compared with the whole texts."""
    candidates = shared.join(rarest.where("_class >= 8"), ["_class", "_anchor"]).select(text_id, "_key")
    return lowered.join(candidates, text_id).where(F.contains(F.col("_text"), F.col("_key"))).select(text_id, "_key")


def contained_keys(
    texts: DataFrame, text_id: str, text: str, keys: DataFrame, key_id: str, key: str
) -> DataFrame:
    """Pairs (text id, key id) where the key text occurs in the text, letter case ignored.

    Exact for every key length.  Each text is reduced to the fingerprints any contained key must share; a key
    then looks only at the texts with its rarest fingerprint, and the whole texts are compared for those.
    Texts longer than one executor's batch are never cut.
    """
    lowered, wanted, shared, rarest = _candidates(texts, text_id, text, keys, key_id, key)
    # The anchor of a very short key is the key itself; the others are looked for in the whole text.
    short = shared.join(rarest.where("_class < 8"), ["_class", "_anchor"]).select(text_id, "_key")
    hits = _long_hits(lowered, text_id, shared, rarest).unionByName(short)
    return hits.join(wanted, "_key").select(text_id, key_id)


def key_hits(texts: DataFrame, text_id: str, text: str, keys: DataFrame, key_id: str, key: str) -> DataFrame:
    """Every key with the number of texts it occurs in, zero included."""
    lowered, wanted, shared, rarest = _candidates(texts, text_id, text, keys, key_id, key)
    # A very short key is its own anchor, whose texts are counted already: no pairs of texts and keys are made.
    short = rarest.where("_class < 8").select("_key", F.col("_n").alias("hits"))
    long = _long_hits(lowered, text_id, shared, rarest).groupBy("_key").agg(F.count("*").alias("hits"))
    counted = short.unionByName(long).join(wanted, "_key").select(key_id, "hits")
    return left_join_filled(keys.select(key_id), counted, [key_id], {"hits": 0})


def exposure_report(hits: DataFrame) -> DataFrame:
    """One row: keys checked, keys found at all, most hits of one key."""
    return hits.agg(
        F.count("*").alias("keys_checked"),
        F.count_if(F.col("hits") > 0).alias("keys_found"),
        F.max("hits").alias("max_hits"),
    )
