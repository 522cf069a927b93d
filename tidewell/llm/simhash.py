"""SimHash near-dedup by generalised pigeonhole.

A fingerprint has a bit set if over half of the document's shingle hashes have it. Two fingerprints link at
``LINK`` or fewer differing bits. To find the links, the 64 bits are cut into parts with a threshold each: if the
thresholds t_i satisfy sum(t_i + 1) = LINK + 1, linked fingerprints differ by at most t_i bits in some part i
(a threshold of -1 leaves the part out). Bits that correlate are put into one part, and the thresholds are
unequal: dynamic programming picks those with the least estimated cost of probes and candidates, for several
numbers of parts, from the measured distances within each part.

Only distinct fingerprints are compared. Each is sent to the buckets its parts probe; within a bucket a search
from fingerprint to fingerprint, each taken off the list once linked, gives links that connect whatever is
connected there, instead of all pairs of a large group. A bucket with more than ``BLOCK`` fingerprints is cut
into blocks and each pair of blocks is searched on its own, so that no task holds more.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import partitions, stored, tune
from tidewell.llm.graph import components

BITS, LINK, WORDS, SEED = 64, 4, 4, 42
BLOCK = 4096
#: Fingerprints whose distances are measured to estimate candidates. All are probed and verified.
SAMPLE = 2048
#: Cost of a probe (a row through the shuffle) in units of one comparison.
PROBE_COST = 60.0

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- fingerprints ---------------------------------------------------------------------------------------------

#: Shingles whose bits are counted in one numpy step.
STEP = 1 << 16


def fingerprint(text: str | None) -> int:
    """The fingerprint of a whole text, unsigned; 0 without a word (a null or empty text too)."""
    words = _WORD.findall((text or "").encode("utf-8").translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    digest = xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        return digest(joined, SEED)  # one shingle: its set bits are the majority
    starts = [0, *(e + 1 for e in ends[: len(words) - WORDS])]
    counts = np.zeros(BITS, np.int64)
    total = len(starts)
    for a in range(0, total, STEP):
        cut = slice(a, a + STEP)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[cut], ends[WORDS - 1 :][cut])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, id: str, keyed: bool = False) -> DataFrame:
    """(id, fp), and the MD5 of the text as ``key`` if asked for."""
    tune(docs.sparkSession)
    plain = docs[f"`{text}`"].cast("string")
    rows = docs.select(docs[f"`{id}`"].alias("id"), *([F.md5(F.coalesce(plain, F.lit(""))).alias("key")] if keyed else []), plain.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found)], [*b.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType(), False)]))


# --- parts and thresholds ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int


def probes(width: int, threshold: int) -> float:
    """Buckets a fingerprint goes to on average: itself and what setting up to ``threshold`` clear bits gives."""
    return 0.0 if threshold < 0 else sum(math.comb(width, k) / 2**k for k in range(threshold + 1))


def correlated_groups(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size: each group starts with the free bit that correlates most
    with the other free ones and takes the bits that correlate most with those it has."""
    strength = np.abs(correlation)
    free = list(range(BITS))
    groups = []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        first = max(free, key=lambda b: (strength[b, free].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            nearest = max(free, key=lambda b: (strength[b, group].sum(), -b))
            group.append(nearest)
            free.remove(nearest)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = budget and the least sum of costs[i][t_i + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for more in range(min(len(cost) - 1, budget - used) + 1):
                option = (total + cost[more], [*chosen, more - 1])
                if used + more not in step or option < step[used + more]:
                    step[used + more] = option
        best = step
    return best.get(budget, (math.inf, []))


def choose_parts(correlation: np.ndarray, sample: np.ndarray, rows: int) -> list[Part]:
    """The cheapest parts and thresholds for ``rows`` distinct fingerprints like those of ``sample``."""
    bits = np.unpackbits(sample.astype(np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    pairs = rows * (rows - 1) / 2
    best: tuple[float, list[Part]] = (math.inf, [])
    for parts in range(1, 9):
        groups = correlated_groups(correlation, parts)
        costs = []
        for group in groups:
            own = bits[:, group]
            ones = own.sum(axis=1)
            distance = ones[:, None] + ones[None, :] - 2 * (own @ own.T)
            upper = distance[np.triu_indices(len(own), 1)]
            row = [0.0]
            for t in range(LINK + 1):
                near = float((upper <= t).mean()) if len(upper) else 0.0
                near = max(near, 2.0 ** -len(group) * sum(math.comb(len(group), k) for k in range(t + 1)))
                row.append(PROBE_COST * rows * probes(len(group), t) + near * pairs)
            costs.append(row)
        cost, thresholds = allocate(costs, LINK + 1)
        if cost < best[0]:
            best = (cost, [Part(tuple(g), t) for g, t in zip(groups, thresholds) if t >= 0])
    return best[1]


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and correlation of their bits, from one sum of 64 x 64 counts a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            x = np.unpackbits(b.column("fp").to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += x.T @ x
            n += len(x)
        if n:
            at = np.append(np.arange(BITS * BITS), -1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(both.ravel(), n).astype(np.int64))], ["at", "n"])

    sums = {r.at: r.n for r in fps.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    n = sums.get(-1, 0)
    if not n:
        return 0, np.eye(BITS)
    both = np.array([sums[i] for i in range(BITS * BITS)], float).reshape(BITS, BITS) / n
    p = both.diagonal()
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return n, np.divide(both - np.outer(p, p), spread, out=np.zeros_like(both), where=spread > 0)


# --- probing ------------------------------------------------------------------------------------------------------


def _signatures(fps: np.ndarray, part: Part) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, signature): its own bits of the part, and these with up to t clear bits set.
    Two that differ by at most t bits meet in the signature that has the bits of both."""
    own = np.zeros(len(fps), np.uint64)
    for k, bit in enumerate(part.bits):
        own |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    index, values = [np.arange(len(fps))], [own]
    for count in range(1, part.threshold + 1):
        for chosen in itertools.combinations(range(len(part.bits)), count):
            mask = np.uint64(sum(1 << k for k in chosen))
            clear = np.flatnonzero((own & mask) == 0)
            index.append(clear)
            values.append(own[clear] | mask)
    return np.concatenate(index), np.concatenate(values)


def probe_rows(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """(part, sig, fp) for all buckets that each distinct fingerprint goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("fp").to_numpy().view(np.uint64)
            for p, part in enumerate(parts):
                for a in range(0, len(values), 256):
                    some = values[a : a + 256]
                    index, sig = _signatures(some, part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(sig), p, np.int32)), pa.array(sig.view(np.int64)), pa.array(some[index].view(np.int64))],
                        ["part", "sig", "fp"],
                    )

    return fps.select("fp").mapInArrow(run, "part int, sig long, fp long")


def _connect(values: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links (a, b) at LINK or fewer differing bits that connect all of ``values`` that such links connect."""
    left, a, b = np.unique(values), [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= LINK
            if near.any():
                found = left[near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    return a, b


#: Buckets up to this size are compared pair by pair, all buckets of one size in one numpy step.
SMALL = 6


def _bucket_links(key_change: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within each bucket of rows sorted by bucket; key_change marks the first row of each."""
    starts = np.flatnonzero(key_change)
    sizes = np.diff(np.append(starts, len(fps)))
    a, b = [], []
    for n in range(2, SMALL + 1):
        at = starts[sizes == n]
        for i, j in itertools.combinations(range(n), 2):
            x, y = fps[at + i], fps[at + j]
            near = (np.bitwise_count(x ^ y) <= LINK) & (x != y)
            a.append(x[near])
            b.append(y[near])
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        more_a, more_b = _connect(fps[s : s + n])
        a.extend(more_a)
        b.extend(more_b)
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, sig, i, j): the last bucket of a batch waits for the next one. A bucket has at most
    two blocks of fingerprints."""
    kept: list[np.ndarray] | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            columns = [batch.column(c).to_numpy() for c in ("part", "sig", "i", "j", "fp")]
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns)]
        elif kept is None:
            return
        else:
            columns = kept
        change = np.ones(len(columns[0]), bool)
        if len(change) > 1:
            change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])
        end = len(change) if batch is None else (int(np.flatnonzero(change)[-1]) if len(change) else 0)
        a, b = _bucket_links(change[:end], columns[4][:end].view(np.uint64))
        if len(a):
            links = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, k].copy().view(np.int64)) for k in (0, 1)], ["a", "b"])
        kept = [c[end:].copy() for c in columns]


def links(fps: DataFrame, parts: list[Part], block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all that are at LINK or fewer differing bits."""
    spark = tune(fps.sparkSession)
    rows = probe_rows(fps, parts)
    hot = (
        rows.groupBy("part", "sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
        .select("part", "sig", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    cut = (
        rows.join(hot, ["part", "sig"], "left")
        .select("part", "sig", "fp", F.explode(F.when(F.col("blocks").isNull(), single).otherwise(others)).alias("at"))
        .select("part", "sig", "at.i", "at.j", "fp")
    )
    key = ["part", "sig", "i", "j"]
    return cut.repartition(partitions(spark), *key).sortWithinPartitions(*key).mapInArrow(_search, "a long, b long")


def _rooted(fps: DataFrame) -> DataFrame:
    """(fp, least, root) from the distinct fingerprints (fp, least): those that links connect have one root."""
    count, correlation = bit_statistics(fps)
    # The smallest by hash: a draw that does not depend on how the rows lie.
    drawn = [r.fp for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    parts = choose_parts(correlation, np.array(drawn, np.int64).view(np.uint64), count) if count > 1 else []
    if not parts:
        return fps.select("fp", "least", F.col("fp").alias("root"))
    found = components(links(fps, parts))
    return fps.join(found, fps.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def group(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each row's id, ``fingerprint`` (16 hex digits) and ``component_id``: the smallest id of the rows that links
    can reach, itself included.

    A text without words has fingerprint zero and links like any other. Ids that are null are passed over by
    component_id unless the group has no other. Repeated rows give repeated rows. No rows give no rows.
    """
    tune(docs.sparkSession)
    prints = stored(with_fingerprints(docs, text, id), "fingerprints")
    rooted = _rooted(stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(of, "fp").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id, of several with that id the one
    whose text has the smallest MD5.

    A row goes by its id and text together, so of rows that share an id each stands for its own text: one that is
    like no other stays. Rows that are equal in both stay or go together; rows whose id is null stay. A null text
    counts as empty; texts without words are one group. An empty table stays empty, other columns stay as they are.
    """
    tune(docs.sparkSession)
    prints = stored(with_fingerprints(docs, text, id, keyed=True), "fingerprints")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "key"))).alias("least")
    rooted = _rooted(stored(prints.groupBy("fp").agg(first), "distinct-fingerprints"))
    least = rooted.groupBy("root").agg(F.min("least").alias("stays"))
    of = rooted.select("fp", "root").join(least, "root").select("fp", "stays")
    near = prints.join(of, "fp").where(F.col("id").isNotNull() & (F.struct("id", "key") != F.col("stays")))
    # Stored, so that Spark knows its size when it plans the join: a small one is broadcast and no text moves.
    gone = stored(near.select(F.col("id").alias("_gone"), F.col("key").alias("_gone_key")).distinct(), "near-copies")
    own = F.md5(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")))
    return docs.join(gone, (docs[f"`{id}`"] == gone["_gone"]) & (own == gone["_gone_key"]), "left_anti")
