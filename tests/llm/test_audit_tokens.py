"""Filter interactions against whole removal runs, token counts against the library."""

import itertools
import random
import re
from collections import Counter

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import audit, queries, token_heap


def _fails(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = len(re.findall("[A-Z]", text))
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * capitals > 2 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": smaller,
    }


def _expected(docs, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = [(i, s or "", _fails(t or "", i is not None and least[t or ""] < i)) for i, t, s in docs]
    out = {}
    for part in {s for _, s, _ in rows}:
        mine = [(i, f) for i, s, f in rows if s == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                shapley[letter] += len(gone)
                failing = sum(f[letter] for _, f in mine)
                alone = sum(f[letter] and sum(f.values()) == 1 for _, f in mine)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def _audit_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = [" ".join(word() for _ in range(rng.choice([5, 199, 200, 400]))) for _ in range(30)]
    texts += [t.upper() for t in texts[:5]] + [t + " $" for t in texts[5:9]] + ["same again " * 150] * 40 + [None, "", "", " \n\t ", "é É A"]
    docs = [(i, t, rng.choice(["x", "y", None, "dé"])) for i, t in enumerate(texts)]
    docs += [docs[3], docs[3], (3, texts[4], "y"), (None, texts[40], "x"), (None, None, None), (-5, texts[7], "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 80, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (999, 1, 1)]
    return docs, labels


def test_interactions_against_removal_runs(spark):
    docs, labels = _audit_rows()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit("e") for c in ("part", "mask", "digest", "good", "n")})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit(1))
    got = {(r.part, r.filter_order, r.step): [r[c] for c in audit.MEASURES] for r in audit.interactions(audit.masked(df.repartition(3), lab)).collect()}
    assert got == _expected(docs, labels)


def test_interactions_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.masked(docs, labels)).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, source string")
    assert audit.interactions(audit.masked(one, labels)).count() == 600


def test_walk_over_other_numbers_of_filters():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 6):
        cells = rng.integers(0, 50, (1 << k, 3, 4))
        states = audit.subset_survivors(cells, k)
        for subset in range(1 << k):
            alive = [m for m in range(1 << k) if not m & subset]
            assert (states[subset] == cells[alive].sum(axis=0)).all()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_file())


def _counts(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


SPECIAL = "<|endoftext|>"


def test_counts_against_the_library(spark, library):
    rng = random.Random(8)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "'", "x'v", "é", "日本", "😀", "1", "234", "!!", " ", "　", "²", "Ⅷ", "٣", "́", "\x00", SPECIAL, "<|end", "oftext|>", "İ", "ﬀ", "﻿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(500)]
    texts += ["a" * 100_000, " " * 50_000, "ab" * 30_000 + SPECIAL * 3, "".join(rng.choice("abcdefghij") for _ in range(200_000)), "1" * 9999, "!" * 9999, "' s" * 99]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in token_heap.count_tokens(df, queries.tokenizer_file()).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == _counts(library, texts)
    assert [got[i].n_bytes for i in range(len(texts))] == [len(t.encode()) for t in texts]


def test_counts_of_awkward_rows_keep_their_columns(spark, library):
    df = helpers.awkward(spark, random.Random(4)).withColumn("n_tokens", F.lit("old"))
    rows = df.collect()
    out = token_heap.count_tokens(df, queries.tokenizer_file())
    assert out.columns == [c for c in df.columns if c not in ("text", "n_tokens")] + ["n_bytes", "n_tokens"]
    got = sorted((str(r.doc_id), r.lang or "", r.n_bytes, r.n_tokens) for r in out.collect())
    assert got == sorted((str(r.doc_id), r.lang or "", len((r.text or "").encode()), n) for r, n in zip(rows, _counts(library, [r.text for r in rows])))
    assert token_heap.count_tokens(df.limit(0), queries.tokenizer_file()).count() == 0


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        token_heap.load(public_tokenizers.path("word_bpe_49k.json"))


def test_count_query_against_the_library(spark, sf, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    want = dict(zip(docs, _counts(library, list(docs.values()))))
    rows = queries.op13_token_counts(spark, sf).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {(i, len(t.encode()), want[i], want[i] > 1024) for i, t in docs.items()}
    assert len(rows) == len(docs)
