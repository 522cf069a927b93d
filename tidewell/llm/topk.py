"""Exact top-k inner products by norm buckets.

Vectors are grouped by length into buckets of at most ``BUCKET``. A query has a running bound: its k-th best
product so far. In a bucket whose longest vector has length l, a candidate can only get in if its cosine with the
query is at least theta = bound / (|q| l), the local threshold. A bucket with theta over 1 is passed over. Otherwise
the pruning is chosen by theta: when it is high, the query's largest coordinate bounds the same coordinate of the
candidates (an angle of at most acos theta around the query); when it is low, only vectors of length bound / |q| or
more are looked at. What is left is verified by the full integer product.

Buckets are rows of a table, spread over the executors. Queries are dealt into blocks, and a tile of some blocks and
some buckets is one task's work at a time, so its memory is bounded. The bounds that queries start with come from
a first pass over the longest buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.base import partitions, stored, tune

SCALE = 1024
#: Vectors of a bucket, queries of a block, buckets and blocks of a tile.
BUCKET, BLOCK, TILE = 2048, 512, 32
#: The local cosine threshold from which a coordinate is looked at first.
COORDINATE_FROM = 0.6
#: Buckets of the first pass.
FIRST = 2
#: Allowance for rounding where lengths and angles are compared.
SLACK = 1e-9
_EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_BLOCKS = "dim int, part int, seq int, longest double, ids binary, data binary"


def to_integers(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, dim, norm, v): floor(1024 x) of each component; vectors that are null or hold a null or a number that is
    not finite are left out, and rows without an id. A component that as an integer does not fit a long fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            dims = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)  # a null reads as NaN
            bad, ends = np.append(0, np.cumsum(~np.isfinite(values))), np.cumsum(dims)
            part = (lists.is_valid().to_numpy(zero_copy_only=False) & b.column("id").is_valid().to_numpy(zero_copy_only=False)) & (bad[ends] == bad[ends - dims])
            whole = np.floor(SCALE * values[np.repeat(part, dims)])
            if len(whole) and not np.abs(whole).max() < 2.0**63:
                raise ValueError(f"a component times {SCALE} does not fit a long")
            dims = dims[part]
            until = np.cumsum(dims)
            if len(dims) and dims[0] and (dims == dims[0]).all():
                norms = np.sqrt((whole.reshape(len(dims), -1) ** 2).sum(axis=1))
            else:
                norms = np.array([np.sqrt((whole[e - d : e] ** 2).sum()) for d, e in zip(dims, until)], np.float64)
            data = memoryview(whole.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").filter(pa.array(part)),
                    pa.array(dims.astype(np.int32)),
                    pa.array(norms, pa.float64()),
                    pa.array([bytes(data[8 * (e - d) : 8 * e]) for d, e in zip(dims.tolist(), until.tolist())], pa.binary()),
                ],
                ["id", "dim", "norm", "v"],
            )

    slim = rows.select(rows[f"`{id}`"].cast("long").alias("id"), rows[f"`{vector}`"].cast("array<double>").alias("v"))
    return slim.mapInArrow(run, "id long, dim int, norm double, v binary")


def _block(table: pa.Table, part: int, seq: int) -> pa.RecordBatch:
    """One row that holds the vectors of ``table``, in its order."""
    ids = table.column("id").to_numpy().astype(np.int64).tobytes()
    longest = float(np.max(table.column("norm").to_numpy()))
    row = (table.column("dim")[0].as_py(), part, seq, longest, ids, b"".join(table.column("v").to_pylist()))
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["dim", "part", "seq", "longest", "ids", "data"])


def buckets(vectors: DataFrame) -> DataFrame:
    """Rows of up to BUCKET vectors of one dimension that are neighbours by length, longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, kept = TaskContext.get().partitionId(), 0, None
        for b in batches:
            now = pa.Table.from_batches([b])
            kept = now if kept is None else pa.concat_tables([kept, now])
            while len(kept):
                dims = kept.column("dim").to_numpy()
                same = int(np.argmax(np.append(dims != dims[0], True)))
                if same == len(kept) < BUCKET:
                    break  # the bucket may go on in the next batch
                n = min(same, BUCKET)
                yield _block(kept.slice(0, n), part, seq)
                seq, kept = seq + 1, kept.slice(n)
        if kept is not None and len(kept):
            yield _block(kept, part, seq)

    key = [F.col("dim"), F.desc("norm"), F.col("id")]
    spark = vectors.sparkSession
    return vectors.repartitionByRange(partitions(spark), *key).sortWithinPartitions(*key).mapInArrow(run, _BLOCKS)


def query_blocks(queries: DataFrame) -> DataFrame:
    """Rows of about BLOCK queries of one dimension, dealt by a hash of their id."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_block(table, key[1].as_py(), 0)])

    count = max(1, -(-queries.count() // BLOCK))
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))
    return dealt.groupBy("dim", "part").applyInArrow(lambda key, t: run(key, t), _BLOCKS)


class _Best:
    """The k best of each query of a block so far, and the bound that follows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, bounds: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.bounds = np.full(len(ids), -np.inf) if bounds is None else bounds.copy()
        self.scores = [np.zeros(0, np.int64) for _ in ids]
        self.found = [np.zeros(0, np.int64) for _ in ids]

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = (scores >= self.bounds[q]) & (ids != self.ids[q])
        if not keep.any():
            return
        scores, ids = np.append(self.scores[q], scores[keep]), np.append(self.found[q], ids[keep])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.found[q] = scores[best], ids[best]
        if len(best) == self.k:
            self.bounds[q] = max(self.bounds[q], scores[best[-1]])

    def meet(self, longest: float, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Look at a bucket, whose vectors are sorted by length, longest first."""
        with np.errstate(divide="ignore", invalid="ignore"):
            theta = self.bounds / (self.norms * longest)
        theta[~np.isfinite(theta) | (self.norms * longest == 0)] = -1.0
        open_ = theta <= 1 + SLACK
        by_coordinate = open_ & (theta >= COORDINATE_FROM) & (vectors.shape[1] > 0)
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        for q in np.flatnonzero(by_coordinate):
            at = self._in_reach(q, theta[q], vectors, norms)
            if len(at):
                self.add(q, _products(self.vectors[q : q + 1], vectors[at])[0], ids[at])
        rest = np.flatnonzero(open_ & ~by_coordinate)
        if len(rest):
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(self.bounds[rest] > 0, self.bounds[rest] / self.norms[rest] * (1 - SLACK), -1.0)
            until = int(np.searchsorted(-norms, -least.min(), side="right"))
            if until:
                scores = _products(self.vectors[rest], vectors[:until])
                for row in np.flatnonzero((scores >= self.bounds[rest][:, None]).any(axis=1)):
                    self.add(int(rest[row]), scores[row], ids[:until])

    def _in_reach(self, q: int, theta: float, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Vectors whose coordinate, where the query's is largest, allows a cosine of theta."""
        own = self.vectors[q] / self.norms[q]
        f = int(np.argmax(np.abs(own)))
        sign = 1.0 if own[f] >= 0 else -1.0
        around, reach = np.arccos(min(1.0, abs(own[f]))), np.arccos(min(1.0, theta))
        low = np.cos(min(np.pi, around + reach)) - SLACK
        high = np.cos(max(0.0, around - reach)) + SLACK
        value = sign * vectors[:, f]
        return np.flatnonzero((value >= low * norms - SLACK) & (value <= high * norms + SLACK))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of integer vectors, exactly; those beyond a long as LEAST and MOST, for the caller to refuse."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2.0**63:
        return a @ b.T
    found = [[sum(x * y for x, y in zip(p, q)) for q in b.tolist()] for p in a.tolist()]
    return np.array([[min(max(x, LEAST), MOST) for x in row] for row in found], np.int64)


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], np.int64).reshape(len(ids), row["dim"])


def _sides(table: pa.Table) -> tuple[list[dict], list[dict]]:
    rows = table.to_pylist()
    ours = sorted((r for r in rows if r["bounds"] is not None), key=lambda r: r["part"])
    theirs = sorted((r for r in rows if r["bounds"] is None), key=lambda r: -r["longest"])
    return ours, theirs


def search(rows: DataFrame, is_query, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), the candidate's id and ``score`` of each query's k best candidates.

    Queries are the rows where the Column ``is_query`` holds, candidates all rows with another id; ties go to the
    smaller id. Only vectors of one dimension are compared. A vector that is null or holds a null or non-finite
    component takes no part. Of rows that repeat an id with different vectors, each is a candidate of its own and
    the one with the greatest components is the query. A query with fewer candidates has fewer rows. Products are
    exact; one of the k best that does not fit a long fails.
    """
    spark = tune(rows.sparkSession)
    vectors = stored(to_integers(rows, id, vector), "vectors")
    # The condition is asked of the id alone once vectors are integers.
    chosen = rows.where(is_query).select(F.col(f"`{id}`").cast("long").alias("id")).distinct()
    queries = stored(
        vectors.join(chosen, "id", "left_semi").groupBy("id", "dim").agg(F.max(F.struct("v", "norm")).alias("m")).select("id", "dim", "m.norm", "m.v"),
        "queries",
    )
    table = stored(buckets(vectors), "buckets")
    blocks = stored(query_blocks(queries), "query-blocks")
    no_bounds = F.lit(None).cast("binary")

    longest = Window.partitionBy("dim").orderBy(F.desc("longest"), "part", "seq")
    first = table.select("dim", "part", "seq", "longest").withColumn("n", F.row_number().over(longest)).where(F.col("n") <= FIRST).drop("n", "longest")
    heads = table.join(first, ["dim", "part", "seq"], "left_semi")

    def bound(t: pa.Table) -> pa.Table:
        ours, theirs = _sides(t)
        out = []
        for block in ours:
            best = _Best(*_arrays(block), k)
            for bucket in theirs:
                best.meet(bucket["longest"], *_arrays(bucket))
            out.append(block | {"bounds": best.bounds.astype(np.float64).tobytes()})
        return pa.Table.from_pylist(out, t.schema)

    mark = F.lit(b"").cast("binary")
    at_block = blocks.select(F.col("part").alias("tile"), *blocks.columns, mark.alias("bounds"))
    met = heads.join(blocks.select("dim", F.col("part").alias("tile")), "dim").select("tile", *heads.columns, no_bounds.alias("bounds"))
    bounded = stored(
        at_block.unionByName(met).groupBy("dim", "tile").applyInArrow(bound, f"tile int, {_BLOCKS}, bounds binary").drop("tile"), "bounded-queries"
    )

    def tile(t: pa.Table) -> pa.Table:
        ours, theirs = _sides(t)
        unpacked = [(b["longest"], *_arrays(b)) for b in theirs]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for block in ours:
            best = _Best(*_arrays(block), k, np.frombuffer(block["bounds"], np.float64))
            for bucket in unpacked:
                best.meet(*bucket)
            found += [(np.full(len(s), q), f, s) for q, f, s in zip(best.ids, best.found, best.scores)]
        columns = [np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(3)]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], ["query_id", "candidate", "score"])

    # Which tiles there are: rows of numbers only, one for each tile of buckets and of blocks.
    of_bucket = F.struct("part", F.floor(F.col("seq") / TILE).cast("int").alias("seq")).alias("tb")
    of_block = F.floor(F.col("part") / TILE).cast("int").alias("tq")
    bucket_tiles = table.select("dim", of_bucket).distinct()
    block_tiles = bounded.select("dim", of_block).distinct()
    theirs = table.withColumn("bounds", no_bounds).select("*", of_bucket).join(block_tiles, "dim")
    ours = bounded.select("*", of_block).join(bucket_tiles, "dim")
    best = (
        ours.unionByName(theirs).groupBy("dim", "tb", "tq").applyInArrow(lambda t: tile(t), "query_id long, candidate long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "candidate")
    fits = F.when(F.col("score").isin(LEAST, MOST), F.raise_error(F.lit("a product does not fit a long")).cast("long")).otherwise(F.col("score"))
    return (
        best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("candidate").alias(id), fits.alias("score"))
    )
