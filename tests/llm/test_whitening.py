"""Whitening against eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from tidewell.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def _brute(vectors, k=4):
    """(n, S, components, eigenvalues, trace) of the distinct integer vectors."""
    whole = sorted({tuple(math.floor(256 * c) for c in v) for v in vectors})
    x = np.array(whole, np.float64)
    centred = x - x.mean(axis=0)
    e, p = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), np.array(whole).sum(axis=0), p[:, ::-1][:, :k], e[::-1][:k], e.sum()


def _check(rows, vectors):
    """vectors: id -> vector, of the rows that take part."""
    n, sums, p, e, trace = _brute(vectors.values())
    k = int((e > 1e-9 * e[0]).sum())
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, c) for i in vectors for c in range(1, k + 1))
    signs = {}
    for r in rows:
        x = np.array([math.floor(256 * c) for c in vectors[r.vec_id]], object)
        c = r.component - 1
        assert r.n == n and int(r.deviation) == sum((n * a - int(b)) ** 2 for a, b in zip(x, sums))
        assert abs(r.explained - e[c] / trace) <= 1e-10 and r.identity_error <= 1e-9
        want = (x.astype(float) - sums / n) @ p[:, c] / math.sqrt(e[c])
        if abs(want) > 1e-3:
            signs.setdefault(c, np.sign(want) * np.sign(r.whitened))
        assert abs(r.whitened * signs.get(c, 1) - want) <= 1e-8 * max(1, abs(want))


@pytest.mark.parametrize("dim,count", [(1, 30), (3, 40), (17, 12), (64, 300)])
def test_components_against_eigenvectors(spark, dim, count):
    rng = np.random.default_rng(dim)
    v = rng.standard_normal((count, dim)) * rng.uniform(0.2, 3, dim) + 5
    rows = [(i, [float(c) for c in row]) for i, row in enumerate(v)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)]  # copies count once in the fit
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    _check(whitening.whiten(df, "vec_id", "embedding").collect(), dict(rows))


def test_rows_that_take_no_part_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.standard_normal(4)], "e", 1) for i in range(20)]
    odd = [(90, None, "e", 1), (91, [], "e", 1), (92, [1.0, None, 2.0, 3.0], "e", 1), (93, [1.0, NAN, 0.0, 0.0], "e", 1), (94, [INF, 0.0, 0.0, 0.0], "e", 1)]
    more = [rows[3], (None, rows[4][1], "e", 1), (50, [-0.0, 0.0, -1e-9, 0.5], None, None)]
    df = spark.createDataFrame(rows + odd + more, "vec_id long, embedding array<float>, component string, n int").repartition(3)
    got = whitening.whiten(df, "vec_id", "embedding").collect()
    exact = {r[0]: [float(np.float32(c)) for c in r[1]] for r in rows + more}
    assert sorted(str(r.vec_id) for r in got) == sorted([str(r[0]) for r in rows + more] * 4)
    seen = {}
    for r in got:
        assert seen.setdefault((r.vec_id, r.component), r) == r
    _check([r for r in seen.values() if r.vec_id is not None], {i: v for i, v in exact.items() if i is not None})


def test_equal_deviations_lower_rank_and_lengths_apart(spark):
    axes = [[float(s * (i == j)) for j in range(6)] for i in range(6) for s in (1, -1)]  # one eigenvalue, six times
    line = [[float(i), 2.0 * i, 0.0] for i in range(9)]  # rank 1
    one = [[7.0, 7.0]] * 4  # nothing to whiten
    rows = list(enumerate(axes + line + one))
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    by_id = dict(rows)
    six = [r for r in got if len(by_id[r.vec_id]) == 6]
    assert len(six) == 48 and all(r.n == 12 and abs(r.explained - 1 / 6) < 1e-12 and r.identity_error < 1e-12 for r in six)
    lined = [r for r in got if len(by_id[r.vec_id]) == 3]
    assert {r.component for r in lined} == {1} and len(lined) == 9 and all(abs(r.explained - 1) < 1e-12 for r in lined)
    assert len(got) == 57


def test_empty_table_and_large_entries(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty, "vec_id", "embedding").count() == 0
    big = [(i, [1e9 * i, float(i % 3), 2e14 * (i % 5)]) for i in range(11)]
    got = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    whole = {i: [math.floor(256 * c) for c in v] for i, v in big}
    sums = [sum(c) for c in zip(*whole.values())]
    for r in got:  # beyond a long, still exact
        assert int(r.deviation) == sum((11 * a - b) ** 2 for a, b in zip(whole[r.vec_id], sums))
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()


def test_query_against_eigenvectors(spark, sf):
    vectors = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r.embedding}
    df = queries.op12_embedding_whitening(spark, sf)
    assert df.schema["deviation"].dataType.typeName() == "long"
    _check(df.collect(), vectors)
