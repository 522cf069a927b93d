import hashlib
import itertools
import random
from collections import defaultdict

import helpers
import numpy as np
import pytest

from tidewell.llm import chunks, exact, graph, simhash


@pytest.fixture(scope="module")
def docs(spark):
    df = helpers.awkward(spark, random.Random(4)).cache()
    return df, df.collect()


def test_exact_against_brute_force(docs):
    df, rows = docs
    groups = defaultdict(list)
    for r in rows:
        groups[helpers.lowered(r.text)].append(r.doc_id)
    got = exact.mark_copies(df).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    seen = defaultdict(list)
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.keep_id == max((i for i in ids if i is not None), default=None) and r.group_size == len(ids)
        seen[r.text_sha256].append((r.doc_id, r.kept))
    for sha, ids in seen.items():
        assert sorted(map(str, (i for i, _ in ids))) == sorted(map(str, by_sha[sha]))
        assert [i for i, kept in ids if kept] == [max((i for i in by_sha[sha] if i is not None), default=None)]


def test_exact_keeps_rows_and_columns(docs):
    df, rows = docs
    got = exact.drop_copies(df)
    assert got.schema.names == df.schema.names
    assert len(got.collect()) == len({helpers.lowered(r.text) for r in rows})


def test_exact_group_over_many_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(i, "copy") for i in range(600)] + [(1000 + i, f"own {i}") for i in range(50)]
        got = exact.mark_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.doc_id for r in got if r.kept} == {599} | {1000 + i for i in range(50)}
    assert all((r.keep_id, r.group_size) == (599, 600) for r in got if r.doc_id < 600) and len(got) == 650


def test_simhash_against_brute_force(docs):
    df, rows = docs
    prints = [helpers.fingerprint(r.text) for r in rows]
    root = helpers.near_groups(prints)
    least = {}
    for r, g in zip(rows, root):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", str(least.get(g))) for r, p, g in zip(rows, prints, root))
    got = simhash.group(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(least.values()) | {None}


def test_simhash_long_text_in_steps(monkeypatch):
    text = " ".join(str(i % 37) for i in range(900))
    monkeypatch.setattr(simhash, "STEP", 50)
    assert simhash.fingerprint(text) == helpers.fingerprint(text)


@pytest.mark.parametrize("rows", [300, 10**7, 10**11])
@pytest.mark.parametrize("block", [8, 4096])
def test_links_connect_what_is_near(spark, rows, block):
    """Whatever parts are chosen and however buckets are cut, the groups are those of all pairs."""
    rng = random.Random(rows)
    values = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # chains and dense balls
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            v ^= 1 << b
        values.append(v)
    values = list(dict.fromkeys(values))
    signed = np.array(values, np.uint64).view(np.int64)
    fps = spark.createDataFrame([(int(x),) for x in signed], "fp long")
    n, correlation = simhash.bit_statistics(fps)
    assert n == len(values)
    parts = simhash.choose_parts(correlation, np.array(values, np.uint64), rows)
    assert sum(p.threshold + 1 for p in parts) == simhash.LINK + 1
    if rows == 10**11 and block == 8:
        return  # two wide parts make hundreds of rows each; one size is enough
    found = simhash.links(fps, parts, block).collect()
    place = {int(x): i for i, x in enumerate(signed)}
    for a, b in found:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= simhash.LINK
    ours, brute = helpers.groups_by(len(values), [(place[a], place[b]) for a, b in found]), helpers.near_groups(values)
    assert len(set(zip(ours, brute))) == len(set(ours)) == len(set(brute))


def test_allocation_is_the_cheapest():
    rng = random.Random(1)
    for parts in (1, 2, 3, 4):
        costs = [[0.0, *sorted(rng.random() * 10 for _ in range(5))] for _ in range(parts)]
        best = min(
            (sum(c[t] for c, t in zip(costs, ts)) for ts in itertools.product(range(6), repeat=parts) if sum(ts) == 5), default=float("inf")
        )
        cost, thresholds = simhash.allocate(costs, 5)
        assert cost == pytest.approx(best) and sum(t + 1 for t in thresholds) == 5


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    place = {x: i for i, x in enumerate(nodes)}
    root = helpers.groups_by(len(nodes), [(place[a], place[b]) for a, b in links if a != b])
    least = {}
    for x, g in zip(nodes, root):
        least[g] = min(least.get(g, x), x)
    assert got == {x: least[g] for x, g in zip(nodes, root)}


def _planted(rng, passages, words):
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts, holders = [prose(rng.randint(5, 200)) for _ in range(150)], set()
    for _ in range(passages):
        p = prose(words)
        for i in rng.sample(range(150), 2):
            texts[i] += f" {prose(rng.randint(0, 9))} {p} {prose(rng.randint(0, 9))}"
            holders.add(i)
    return texts, holders


def test_repeated_passages_are_found_and_cut(spark):
    texts, holders = _planted(random.Random(8), 30, 55)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = chunks.repeated_passages(df).collect()
    assert {r.doc_id for r in got} == holders
    assert all(texts[r.doc_id].encode()[r.start : r.stop].decode() in texts[r.keep_id] or r.keep_id == r.doc_id for r in got if r.removed)
    cut = {r.doc_id: r.text for r in chunks.remove_repeats(df).collect()}
    lost = {r.doc_id for r in got if r.removed}
    assert {i for i, t in enumerate(texts) if cut[i] != t} == lost and all(len(cut[i]) < len(texts[i]) for i in lost)


def test_chunks_resist_insertions_and_do_not_depend_on_steps(monkeypatch):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgé") for _ in range(6)) for _ in range(400)).encode()
    ends = chunks.boundaries(text)
    assert ends[-1] == len(text) and all(0 < b - a <= chunks.MOST for a, b in itertools.pairwise([0, *ends]))
    for a, b in itertools.pairwise([0, *ends]):
        text[a:b].decode()
    moved = chunks.boundaries(b"some new words first " + text)
    assert len(set(ends[-50:]) - {e - 21 for e in moved}) == 0
    monkeypatch.setattr(chunks, "STEP", 100)
    assert chunks.boundaries(text) == ends
    assert chunks.boundaries(b"a" * 1000)[-1] == 1000 and chunks.boundaries(b"") == []


def test_repeats_of_awkward_rows(docs):
    df, rows = docs
    got = chunks.repeated_passages(df).collect()
    assert all(r.doc_id is not None and r.start < r.stop for r in got)
    out = chunks.remove_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)


@pytest.mark.parametrize("run", [exact.mark_copies, exact.drop_copies, simhash.group, simhash.drop_near_copies, chunks.repeated_passages, chunks.remove_repeats])
def test_no_rows(spark, run):
    assert run(spark.createDataFrame([], helpers.COLUMNS)).collect() == []


def test_near_copies_with_shared_ids_lose_no_text(spark):
    rng = random.Random(9)
    a, b, c = (" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80)) for _ in range(3))
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (5, b, "x"), (7, b, "x"), (None, a, "x"), (9, None, "x"), (2, "", "x"), (2, c, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    kept = sorted((str(r.doc_id), r.text or "") for r in simhash.drop_near_copies(df).collect())
    assert kept == sorted([("3", a), ("5", b), ("5", b), ("None", a), ("2", ""), ("2", c)])
