"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers; the fit list holds each distinct one once, in blocks of rows in the shared folder. With X
the centred fit list, a step makes u = X v - beta u' and then v = X'u - alpha v, each orthogonalised against all its
predecessors twice. Both products are passes over the blocks that add up per task and then by coordinate, so what
reaches the driver is one vector as long as an embedding. The u are as long as the fit list and never leave the
tasks: each is X t for a short vector t that the driver keeps, so a lost executor loses nothing. The singular values
and right vectors of the small bidiagonal matrix give the components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import stored, tune

SCALE = 256
COMPONENTS = 4
#: Part of the largest singular value under which a residual, and a further singular value, is rounding.
CONVERGED, NOTHING = 1e-14, 1e-11
_LONG = 1 << 63
_WIDTHS = (np.int16, np.int32, np.int64)


def _whole(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, lengths, integers of all of them in a row) of the vectors that take part."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null reads as NaN
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    ends = np.cumsum(lengths)
    takes_part = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths]) & (lengths > 0)
    values = np.floor(values[np.repeat(takes_part, lengths)] * SCALE)
    if len(values) and not np.abs(values).max() < _LONG:
        raise ValueError(f"a component times {SCALE} does not fit a long")
    return np.flatnonzero(takes_part), lengths[takes_part], values.astype(np.int64)


def _vectors(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integers by row) for each length of vector in a batch."""
    rows, lengths, flat = _whole(lists)
    for d in np.unique(lengths):
        same = lengths == d
        yield rows[same], flat[np.repeat(same, lengths)].reshape(-1, d)


def fit_list(rows: DataFrame, vector: str) -> DataFrame:
    """Blocks (dim, width, data) of the distinct integer vectors, stored in the shared folder."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, x in _vectors(b.column("v")):
                size = np.abs(x).max(axis=1)
                keys = [r.astype(_WIDTHS[int(m >= 1 << 15) + int(m >= 1 << 31)]).tobytes() for r, m in zip(x, size)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(keys, pa.binary())], ["dim", "x"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, keys = b.column("dim").to_numpy(), b.column("x").to_pylist()
            sizes = np.array([len(k) for k in keys]) // np.maximum(dims, 1)
            for d, w in sorted(set(zip(dims.tolist(), sizes.tolist()))):
                data = b"".join(k for k, s, e in zip(keys, dims, sizes) if s == d and e == w)
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([w], pa.int32()), pa.array([data], pa.binary())], ["dim", "width", "data"])

    distinct = rows.select(rows[f"`{vector}`"].alias("v")).mapInArrow(key, "dim int, x binary").distinct()
    return stored(distinct.mapInArrow(block, "dim int, width int, data binary"), "whitening-fit")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        for d, w, data in zip(*(b.column(c).to_pylist() for c in ("dim", "width", "data"))):
            yield np.frombuffer(data, f"<i{w}").reshape(-1, d).astype(np.int64)


def _exact_sums(blocks: DataFrame) -> tuple[list[int], list[int]]:
    """Exact sums by coordinate, after them the number of vectors; and the largest absolute entry by coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = None, None
        for x in _matrices(batches):
            top = np.abs(x).max(axis=0)
            small = int(top.max()) * len(x) < _LONG
            part = np.append((x if small else x.astype(object)).sum(axis=0).astype(object), len(x))
            total, most = (part, top) if total is None else (total + part, np.maximum(most, top))
        if total is not None:
            told = [pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), pa.array([*most.tolist(), 0], pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *told], ["at", "total", "most"])

    parts = blocks.mapInArrow(run, "at int, total decimal(38,0), most long")
    found = sorted(parts.groupBy("at").agg(F.sum("total").alias("total"), F.max("most").alias("most")).collect())
    return [int(r.total) for r in found], [r.most for r in found][:-1]


@dataclass
class Fit:
    """What one length of vector was fitted to. ``columns``: components by column, each over its deviation."""

    n: int
    sums: list[int]
    most: list[int]
    columns: np.ndarray
    explained: np.ndarray
    identity_error: float

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over the coordinates of (n x - S)^2."""
        far = self.n * max(self.most) + max(map(abs, self.sums))
        kind = np.int64 if far * far * len(self.sums) < _LONG else object
        off = self.n * x.astype(kind) - np.array(self.sums, kind)
        return [int(v) for v in (off * off).sum(axis=1)]


class _Passes:
    """Sums over the centred rows of one length of vector."""

    def __init__(self, blocks: DataFrame, dim: int):
        self.blocks, self.dim = blocks.where(F.col("dim") == dim), dim
        sums, self.most = _exact_sums(self.blocks)
        self.n, self.sums = sums.pop(), sums
        self.mean = np.array([s // self.n + s % self.n / self.n for s in self.sums])

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all blocks of what ``of`` makes of a block's centred rows."""
        mean = self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for x in _matrices(batches):
                part = of(x - mean)
                found = part if found is None else found + part
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)], ["at", "value"])

        rows = self.blocks.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(len(rows))
        for at, value in rows:
            out[at] = value
        return out


def _orthogonal(y: np.ndarray, to: np.ndarray) -> np.ndarray:
    for _ in range(2):
        y = y - to @ (to.T @ y)
    return y


def _bidiagonal(passes: _Passes, size: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values of the centred rows and their right vectors (by column).

    It ends when the residuals of those wanted are rounding, or after as many steps as a vector has entries, which
    is exact. Where a step leaves nothing (the rows reach no further, or an eigenvalue repeats), a fresh direction
    starts the next one.
    """
    d, draw = passes.dim, np.random.default_rng(12)
    right, short, image = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # v, t (u = X t), X'u
    alphas, betas = [], []
    v = draw.standard_normal(d)
    v /= np.linalg.norm(v)
    while True:
        k = len(alphas)
        earlier = short
        along = passes.total(lambda x: (x @ earlier).T @ (x @ v)) if k else np.zeros(0)
        t = v - earlier @ along

        def second(x: np.ndarray) -> np.ndarray:
            u = x @ t
            return np.concatenate([(x @ earlier).T @ u, [u @ u], x.T @ u])

        found = passes.total(second)
        again, square, y = found[:k], found[k], found[k + 1 :]
        alpha = float(np.sqrt(max(square - again @ again, 0.0)))
        if alpha <= NOTHING * 1e-2 * size:
            alpha, t, y = 0.0, np.zeros(d), np.zeros(d)
        else:
            t, y = (t - earlier @ again) / alpha, (y - image @ again) / alpha
        right, short, image = (np.column_stack(x) for x in ((right, v), (short, t), (image, y)))
        alphas.append(alpha)
        rest = _orthogonal(y - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        stuck = beta <= NOTHING * 1e-2 * size
        left, values, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        residuals = beta * np.abs(left[-1, :wanted])
        if k + 1 == d or (not stuck and k + 1 >= wanted and (residuals <= CONVERGED * values[0]).all()):
            return values[:wanted], right @ turned[:wanted].T
        while stuck:
            rest = _orthogonal(draw.standard_normal(d), right)
            stuck = np.linalg.norm(rest) < 1e-3
            beta = 0.0
        betas.append(beta)
        v = _orthogonal(rest / np.linalg.norm(rest), right)
        v /= np.linalg.norm(v)


def fit(blocks: DataFrame, dim: int, components: int = COMPONENTS) -> Fit:
    """Components of the fit list's vectors of one length, by falling eigenvalue; a component's largest entry is
    positive. Directions in which the vectors do not differ are no components, so there may be fewer than asked for."""
    passes = _Passes(blocks, dim)
    n = passes.n
    squares = passes.total(lambda x: np.array([(x * x).sum()]))[0]
    if not squares:
        return Fit(n, passes.sums, passes.most, np.zeros((dim, 0)), np.zeros(0), 0.0)
    values, vectors = _bidiagonal(passes, float(np.sqrt(squares)), min(components, dim))
    real = values > NOTHING * values[0]
    values, vectors = values[real], vectors[:, real]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    columns = vectors / (values / np.sqrt(n))
    middle = passes.total(lambda x: (x @ columns).sum(axis=0)) / n
    spread = passes.total(lambda x: ((z := x @ columns - middle).T @ z).ravel()) / n
    error = float(np.abs(spread.reshape(len(values), -1) - np.eye(len(values))).max())
    return Fit(n, passes.sums, passes.most, columns, values**2 / squares, error)


def whiten(rows: DataFrame, id: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    Rows whose vector is null, empty or holds a null or a number that is not finite are left out; a component that
    as an integer does not fit a long fails. Every other row comes out, repeated and null ids too; copies of a vector
    count once in the fit. Vectors of different lengths are fitted apart: the driver goes through the lengths that
    occur. One distinct vector alone, or an empty table, gives no rows. ``deviation`` is exact, of 38 digits.
    Other columns are not read.
    """
    spark = tune(rows.sparkSession)
    blocks = fit_list(rows, vector)
    fits = {r.dim: fit(blocks, r.dim, components) for r in blocks.select("dim").distinct().collect()}
    shared = spark.sparkContext.broadcast(fits)
    kind = T.StructField(id, rows.schema[id].dataType)
    schema = T.StructType([kind, *T.StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _vectors(b.column("v")):
                model = shared.value[x.shape[1]]
                k, m = model.columns.shape[1], len(x)
                if not k:
                    continue
                mean = np.array([s // model.n + s % model.n / model.n for s in model.sums])
                white = (x - mean) @ model.columns
                off = pa.array([Decimal(v) for v in model.deviations(x)], pa.decimal128(38, 0))
                every = np.repeat(np.arange(m), k)
                columns = [b.column("id").take(pa.array(at[every])), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, model.n, np.int64)]
                columns += [off.take(pa.array(every)), white.ravel(), np.tile(model.explained, m), np.full(m * k, model.identity_error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema.names)

    return rows.select(rows[f"`{id}`"].alias("id"), rows[f"`{vector}`"].alias("v")).mapInArrow(run, schema)
