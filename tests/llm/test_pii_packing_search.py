import hashlib
import random
from collections import defaultdict

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import packing, pii, topk

TRICKY = [
    "a@b.co_x@y.com .@c.d-e. q@@r.s", "+1 (234) 567-8901 +1+2 +12345678901234567", "4111 1111 1111 1111-4111111111111111 4111  1111 1111 1111",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.0003.00 1.2.3.4@x.com", "😀 a😀b@c.de 10.0.0.1é 5500005555555559", "", None, "a" * 20_000 + "@" + "b.c" * 5000,
    "1 " * 20_000, "+" + "1" * 12 + "(" * 5000, "9.9.9.9" * 10, "x@y.z@w.v", "a" * 50_000, "1" * 50_000, "+1" * 9000,
]


def _want(text):
    spans = helpers.private_spans(text)
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
    return (*(sum(s[3] == k for s in spans) for k in helpers.PATTERNS), hashlib.sha256(joined.encode()).hexdigest())


@pytest.mark.parametrize("source", ["tricky", "awkward", "random"])
def test_patterns_against_brute_force(spark, source):
    rng = random.Random(6)
    if source == "awkward":
        df = helpers.awkward(spark, rng)
    else:
        parts = ["a", "b.c", "@", ".", "-", " ", "12", "4111111111111111", "+", "(", ")", "1", "255", "256", "é", "_", "\n"]
        texts = TRICKY if source == "tricky" else ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = df.select("doc_id", "text").collect()
    got = pii.detect(df).collect()
    have = sorted((str(r.doc_id), (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)) for r in got)
    assert have == sorted((str(r.doc_id), _want(r.text)) for r in rows)


def _disclosing(rows):
    """(value, term) pairs by the definition, with sets of documents."""
    texts = {i: t for i, t in rows}
    holders, near, has = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t in texts.items():
        for w in set(t.lower().split()):
            has[w].add(i)
        for a, _, b, _ in helpers.private_spans(t):
            value = t[a:b].lower()
            holders[value].add(i)
            for w in set((t[:a] + "\n" + t[b:]).lower().split()):
                near[value, w].add(i)
    n = len(texts)
    out = set()
    for (value, w), docs in near.items():
        together, own = len(docs), len(holders[value])
        if own < n and own >= pii.SUPPORT and together >= pii.SUPPORT:
            if np.log2(together * n / (own * len(has[w]))) >= pii.DISCLOSURE * np.log2(n / own):
                out.add((value, w))
    return out


def test_disclosing_terms_against_brute_force(spark):
    rng = random.Random(12)
    common = "the of and was sent for review by team about paper".split()
    rows = []
    for i in range(60):
        words = [rng.choice(common) for _ in range(5)]
        if i < 30:  # short enough that the whole text is near
            person = i % 5
            words += rng.sample([f"name{'abcde'[person]}", f"city{'abcde'[person]}"], 2 if rng.random() < 0.9 else 1) + [f"box{person}@corp.example"]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _disclosing(rows)
    named = {w for _, w in want}
    assert {f"name{c}" for c in "abcde"} & named
    texts = dict(rows)
    for r in pii.detect(df).collect():
        t, own = texts[r.doc_id], {texts[r.doc_id][a:b].lower() for a, _, b, _ in helpers.private_spans(texts[r.doc_id])}
        spans = [s.split(":") for s in r.spans.split(",") if s]
        found = {t[int(a) : int(b)].lower() for k, a, b in spans if k == "term"}
        allowed = {w for v, w in want if v in own}
        expected = {w for w in allowed if w.isalpha() and len(w) > 1 or w[:4] in ("name", "city")} & set(t.split())
        assert found == expected, (t, found, expected)


def test_disclosing_terms_far_from_the_value_and_without_it(spark):
    filler = "of the and was sent for review " * 20
    rows = [(i, f"dear zoltan {filler} {i} mail zk@corp.example") for i in range(12)] + [(12, "zoltan will call")]
    rows += [(20 + i, f"of the {filler} mail review will call dear") for i in range(400)]
    got = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[12] == "[TERM] will call" and all(got[i] == rows[i][1].replace("zoltan", "[TERM]").replace("zk@corp.example", "[EMAIL]") for i in range(12))
    assert all(got[i] == t for i, t in rows[13:])


def test_sanitised_texts(spark):
    df = helpers.awkward(spark, random.Random(3))
    rows = {r.doc_id: r for r in df.collect()}
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = out.collect()
    for r in got:
        assert not helpers.private_spans(r.text)
        if r.doc_id is not None and not helpers.private_spans(rows[r.doc_id].text):
            assert r == rows[r.doc_id]
        if r.text and "[EMAIL]" in r.text:
            assert r.n_chars == len(r.text)
    assert sum("[EMAIL]" in (r.text or "") for r in got) == 1


def test_overlapping_spans_are_covered(spark):
    df = spark.createDataFrame([(1, "4111 1111 1111 1111@x.com and 10.0.0.1@y.org")], "doc_id long, text string")
    assert pii.sanitise(df).first().text == "[CARD] and [EMAIL]"


# --- packing


def _packed(spark, sizes, **settings):
    df = spark.createDataFrame([(i, n, "e", "e") for i, n in enumerate(sizes)], "doc_id long, n long, bin string, shard string")
    return packing.best_fit(df, "n", **settings).collect()


@pytest.mark.parametrize("shard", [40, 1500])
def test_packing_is_whole_and_fits(spark, shard):
    rng = random.Random(7)
    sizes = [rng.choice([rng.randint(1, 300), rng.randint(1, 9000), 512, 513, 30_000]) for _ in range(300)] + [0, None]
    got = _packed(spark, sizes, shard=shard)
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.piece, r.start, r.n_tokens))
        by_bin[r.shard, r.bin].append(r)
    for i, n in enumerate(sizes):
        parts = sorted(by_doc.get(i, []))
        assert sum(p[2] for p in parts) == (n or 0)
        assert [p[1] for p in parts] == [sum(q[2] for q in parts[:k]) for k in range(len(parts))]
    for rows in by_bin.values():
        rows.sort(key=lambda r: r.offset)
        used = sum(r.n_tokens for r in rows)
        assert [r.offset for r in rows] == [sum(q.n_tokens for q in rows[:k]) for k in range(len(rows))]
        assert {r.capacity for r in rows} == {min(x for x in packing.LENGTHS if x >= used)}


def _plain_pack(sizes, lengths, bin_cost):
    """The rule word by word, with lists."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins = []  # [room, pieces]
    for k, i in enumerate(order):
        n, rest = sizes[i], sum(sizes[j] for j in order[k + 1 :])
        fits = [b for b in range(len(bins)) if bins[b][0] >= n]
        if fits:
            b = min(fits, key=lambda x: (bins[x][0], x))
        else:
            room = min((x for x in lengths if x >= n), key=lambda x: ((x + bin_cost) / (n + min(x - n, rest)), x))
            bins.append([room, []])
            b = len(bins) - 1
        bins[b][0] -= n
        bins[b][1].append(i)
    return sorted(tuple(sorted(p)) for _, p in bins)


def test_packing_against_the_plain_rule():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(1, 40))]
        bins, _, lengths = packing.pack(np.array(sizes), (16, 32, 64), 3)
        groups = defaultdict(list)
        for i, b in enumerate(bins.tolist()):
            groups[b].append(i)
        assert sorted(tuple(sorted(g)) for g in groups.values()) == _plain_pack(sizes, (16, 32, 64), 3)
        assert len(lengths) == len(groups)


def test_packing_lengths_matter():
    """A few short pieces do not open a long bin."""
    _, _, lengths = packing.pack(np.array([100, 90, 80]), (128, 512, 8192), 8)
    assert lengths.sum() <= 512


def test_packing_no_rows(spark):
    assert _packed(spark, [0]) == [] and _packed(spark, [None]) == []


# --- search


def _brute(rows, k=10):
    out = []
    vectors = [(i, np.floor(1024 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in vectors:
        if q % 100 == 0:
            scored = sorted((-int(v @ w), i) for i, w in vectors if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["alike", "lengths", "clusters", "odd"])
def test_search_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BUCKET", 64)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(900, 8))
    if kind == "alike":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif kind == "lengths":
        v *= rng.lognormal(0, 2, size=(900, 1))
    elif kind == "clusters":  # near copies of a few axes: high local thresholds, where a coordinate prunes
        v = np.eye(8)[rng.integers(0, 8, 900)] * rng.choice([-1, 1], size=(900, 1)) + 0.02 * v
    rows = [(i, [float(x) for x in np.float32(r)]) for i, r in enumerate(v)]
    if kind == "odd":
        rows = [(i, r if i % 3 else [0.5] * 8) for i, r in rows]  # a third of all vectors alike: ties
        rows += [(1000, None), (1100, [1.0, None] * 4), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (None, [1.0] * 8), (1400, [0.0] * 8), (1500, [1.0] * 5), (1501, [2.0] * 5), (1600, [])]
    df = spark.createDataFrame([(i, r, "e", "e", 1) for i, r in rows], "vec_id long, embedding array<float>, dim string, score string, rank int").repartition(4)
    got = topk.search(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted(tuple(r) for r in got) == _brute(rows)


def test_search_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, F.col("vec_id") % 100 == 0).collect() == []


def test_search_large_numbers():
    a = np.array([[2**30, -(2**30)], [3, 4]])
    assert topk._products(a, a).tolist() == [[2**61, -(2**30)], [-(2**30), 25]]
    assert topk._products(a * 2, a).tolist() == [[2**62, -(2**31)], [-(2**31), 50]]


def test_search_with_components_beyond_31_bits(spark):
    big = [(0, [3e6, 1.0]), (1, [1.0, 2.0]), (2, [-2.5e6, 5.0]), (100, [2.2e6, -7.5]), (3, [0.5, -2.4e6]), (4, [2.0, None]), (5, [float("inf"), 1.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>").repartition(3)
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in big if i not in (4, 5)}
    want = []
    for q in (0, 100):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q))
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0).collect()) == want


@pytest.mark.parametrize("rows", [[(0, [1e16]), (1, [1e16])], [(0, [1e16]), (1, [-1e16])], [(0, [1e18]), (1, [1.0])]])
def test_search_fails_where_a_long_is_too_short(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.search(df, F.col("vec_id") % 100 == 0).collect()
