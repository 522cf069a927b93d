import base64
import hashlib
import itertools
import random
import re
import time

import helpers
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidewell.llm import base, bpe, html, langid, quality
from tidewell.llm.queries import rank_file


@pytest.fixture(scope="module")
def docs(spark):
    df = helpers.awkward(spark, random.Random(9)).cache()
    return df, df.collect()


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rank_file(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- byte-level BPE


PARTS = [*"aabre vs''  \n\t12.,-lldtm", "é", "ß", "中", "😀", " ", "　", "٣", "\x1c", "'re", "'ll ", "\r\n", "Ᲊ"]


def test_bpe_against_the_public_library(public):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(50))) for _ in range(3000)] + ["", "a" * 3000, "ab" * 300 + " x"]
    encoder = bpe.load(rank_file())
    ids, offsets, numbers = encoder.encode(texts)
    ends = np.append(0, np.cumsum(numbers))
    for t, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == public.encode_ordinary(t), t
        widths = [len(public.decode_single_token_bytes(i)) for i in ids[a:b].tolist()]
        assert offsets[a:b].tolist() == [0, *itertools.accumulate(widths)][: b - a]


@pytest.mark.parametrize("step", [20, 64])
def test_bpe_long_texts_in_pieces(public, monkeypatch, step):
    rng = random.Random(step)
    monkeypatch.setattr(bpe, "STEP", step)
    encoder = bpe.load(rank_file())
    for _ in range(10):
        text = "".join(rng.choice(PARTS) for _ in range(1500)) + "q" * 200 + " don't" + " " * rng.randrange(3)
        ids, _, numbers = encoder.encode([text, "x"])
        assert ids.tolist() == public.encode_ordinary(text) + public.encode_ordinary("x")
        assert encoder.encode([text, "x"], count_only=True)[2].tolist() == numbers.tolist() == [len(ids) - 1, 1]


def test_bpe_long_merge_equals_short():
    encoder, rng = bpe.load(rank_file()), random.Random(5)
    pieces = [bytes(rng.choice(b"theinganro ") for _ in range(rng.randint(2, 40))) for _ in range(400)]
    assert encoder._merge_many(pieces) == [encoder._merge_long(p) for p in pieces]


def test_bpe_round_trip_of_awkward_rows(docs, public):
    df, rows = docs
    encoded = bpe.encode(df, rank_file())
    assert set(encoded.columns) == set(df.columns) - {"text"}
    got = bpe.decode(encoded, rank_file()).select("doc_id", "ids", "decoded").collect()
    want = sorted((str(r.doc_id), tuple(public.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in rows)
    assert sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded)) for r in got) == want


# --- language ID


def test_language_held_out_accuracy(spark, sf):
    docs = base.table(spark, sf, "documents")
    model = langid.train(docs)
    got = langid.identify(docs, model).where(langid.held_out("doc_id")).select("lang", "lang_pred", "rejected").collect()
    assert got and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and not any(r.rejected for r in got)


def test_language_rejects_what_is_unlike_all_learned(spark, sf):
    model = langid.train(base.table(spark, sf, "documents"))
    rng = random.Random(3)
    unlike = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
        "人人生而自由,在尊严和权利上一律平等",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem i sumieniem",
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(60)),
        base64.b64encode(rng.randbytes(600)).decode(),
    ]
    assert langid.predict(model, unlike)[2] == [True] * len(unlike)


def test_language_learns_from_other_rows_only(spark, sf):
    """Other texts and languages in held-out rows change nothing."""
    docs = base.table(spark, sf, "documents").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(langid.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    a, b = langid.train(docs), langid.train(other)
    assert a.languages == b.languages and np.array_equal(a.scores, b.scores) and a.threshold == b.threshold


def test_language_of_awkward_rows(docs):
    df, rows = docs
    model = langid.train(df)
    out = langid.identify(df, model)
    assert len(out.collect()) == len(rows) and set(model.languages) <= {"en", "fr"}
    for r in out.select("text", "lang_pred", "score", "rejected").collect():
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1 and (letter or r.rejected)


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    got = langid.identify(df, langid.train(df)).collect()
    assert {r.lang_pred for r in got} == {"und"} and all(r.score == 0 and r.rejected for r in got)


def test_language_subwords_do_not_depend_on_steps(monkeypatch):
    points = base.code_points("some words, and others; " * 200)
    whole = langid.histogram(points)
    monkeypatch.setattr(langid, "STEP", 100)
    assert np.array_equal(langid.histogram(points), whole)


# --- quality


def test_probabilities_add_up(spark, sf):
    good = base.table(spark, sf, "documents").limit(40)
    p = 2.0 ** -quality.train(good).astype(float)
    sums = p.reshape(-1, quality.SYMBOLS).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3)


def test_perplexity_against_brute_force(spark):
    """One n-gram at a time, with counts in dictionaries."""
    texts = ["the cat sat on the mat.", "the dog sat, the cat ran!", "a cat and a dog", "on and on and on"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bits = quality.train(df)
    n, size = quality.ORDER, quality.SYMBOLS
    seen = {n: {}}
    for t in texts:
        s = [0] * (n - 1) + quality.symbols(base.code_points(t)).tolist()
        for i in range(n - 1, len(s)):
            g = tuple(s[i - n + 1 : i + 1])
            seen[n][g] = seen[n].get(g, 0) + 1
    for k in range(n - 1, 0, -1):
        seen[k] = {}
        for g in seen[k + 1]:
            seen[k][g[1:]] = seen[k].get(g[1:], 0) + 1

    def discounts(counts):
        m = [sum(c == k for c in counts.values()) for k in range(1, 5)]
        if not (m[0] and m[1]):
            return (0.5, 0.5, 0.5)
        y = m[0] / (m[0] + 2 * m[1])
        raw = (1 - 2 * y * m[1] / m[0], 2 - 3 * y * m[2] / m[1], 3 - 4 * y * m[3] / m[2] if m[2] else 1.5)
        return tuple(min(max(x, 0.05), top) for x, top in zip(raw, (0.95, 1.9, 2.9)))

    d = {k: discounts(seen[k]) for k in seen}

    def p(g):
        if not g:
            return 1 / size
        k = len(g)
        same = {x: c for x, c in seen[k].items() if x[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        cut = lambda c: d[k][min(c, 3) - 1]
        total = sum(same.values())
        own = (same[g] - cut(same[g])) / total if g in same else 0.0
        return own + sum(map(cut, same.values())) / total * p(g[1:])

    rng = random.Random(1)
    tried = [*seen[n], *(tuple(rng.randrange(size) for _ in range(n)) for _ in range(200))]
    for g in tried:
        key = 0
        for x in g:
            key = key * size + x
        assert bits[key] == pytest.approx(-np.log2(p(g)), rel=1e-4), g


def test_characters_of_a_class_are_told_apart(spark):
    """é and ñ, % and @, and letters eight code points apart share a class."""
    texts = ["l'été est passé à 5 % près", "мама мыла раму", "état à 7 %"] * 3
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    changed = [texts[0].replace("é", "ñ"), texts[0].replace("%", "@"), "".join(chr(ord(c) + 8) if c != " " else c for c in texts[1])]
    others = spark.createDataFrame([(100 + i, t, "x") for i, t in enumerate(changed)], df.schema)
    for t, o in zip([texts[0], texts[0], texts[1]], changed):
        assert (quality.symbols(base.code_points(t)) == quality.symbols(base.code_points(o))).all()
    got = {r.doc_id: r.perplexity for r in quality.classify(df.union(others), df.select("doc_id")).collect()}
    assert all(got[100 + i] > 1.05 * got[j] for i, j in enumerate((0, 0, 1)))

    # Against counts in dictionaries, and all characters of a class together.
    counted = base.stored(quality.count(df, "text"), "counts")
    p = 2.0 ** -quality._character_bits(counted).astype(float)
    kinds, own = quality._classed(np.arange(quality.POINTS, dtype=np.uint32))
    one_each = np.unique(own)
    assert np.allclose(np.bincount(kinds[one_each], weights=p[one_each], minlength=quality.SYMBOLS)[np.unique(kinds)], 1, atol=1e-5)
    seen = {}
    for t in texts:
        for c in " ".join(t.split()):
            seen[c] = seen.get(c, 0) + 1
    d = quality._discounts(spark.createDataFrame(list(seen.items()), "gram string, c long"))
    for c in "é%5мñ'a z":
        group = {x: n for x, n in seen.items() if kinds[ord(x)] == kinds[ord(c)]}
        total, cut = sum(group.values()), lambda n: d[min(n, 3) - 1]
        members = len({own[x] for x in np.flatnonzero(kinds == kinds[ord(c)])})
        expected = 1 / members
        if group:
            expected = sum(map(cut, group.values())) / total / members + ((group[c] - cut(group[c])) / total if c in group else 0)
        assert p[ord(c)] == pytest.approx(expected, rel=1e-4), c


def test_what_stands_before_a_character_counts(spark):
    """é and ñ share a class and are as frequent as each other, but each has its own word before it."""
    texts = ["tu é", "no ñ"] * 20
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + ["tu ñ", "no é"])], "doc_id long, text string, lang string")
    got = {r.doc_id: r.perplexity for r in quality.classify(df, df.where("doc_id < 40").select("doc_id")).collect()}
    assert (quality.symbols(base.code_points("tu ñ")) == quality.symbols(base.code_points("tu é"))).all()
    assert got[40] > 1.005 * got[0] and got[41] > 1.005 * got[1]


@pytest.mark.parametrize("wide", [False, True])
def test_character_ngrams_against_brute_force(spark, monkeypatch, wide):
    """Sums of bits per text, one n-gram at a time, with counts in dictionaries; also of n-grams that fit no number."""
    if wide:
        monkeypatch.setattr(quality, "_coded", lambda characters, letters: None)
    rng = random.Random(3)
    words = ["thé", "Cat", "sat,", "on", "año", "мат", "中文", "\0", "a😀", " \n", "7%"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(24)] + ["", "ЖЖ zzz 文中"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, lang string").repartition(3)
    n, folded = quality.ORDER, [re.sub(r"\s+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    windows = lambda t: [(" " * (n - 1) + t)[i : i + n] for i in range(len(t))]
    seen = {n: {}}
    for t in folded[:16]:
        for g in windows(t):
            seen[n][g] = seen[n].get(g, 0) + 1
    for k in range(n - 1, 1, -1):
        seen[k] = {}
        for g in seen[k + 1]:
            seen[k][g[1:]] = seen[k].get(g[1:], 0) + 1
    d = {k: quality._discounts(spark.createDataFrame(list(seen[k].items()), "gram string, c long")) for k in seen}
    counted = base.stored(quality.count(df.where("id < 16"), "text"), "counts")
    table, own_bits = quality._gram_bits(counted), quality._character_bits(counted)

    def p(g, bottom):
        if len(g) == 1:
            return bottom
        same = {x: c for x, c in seen[len(g)].items() if x[:-1] == g[:-1]}
        if not same:
            return p(g[1:], bottom)
        cut = lambda c: d[len(g)][min(c, 3) - 1]
        total = sum(same.values())
        return (same[g] - cut(same[g]) if g in same else 0) / total + sum(map(cut, same.values())) / total * p(g[1:], bottom)

    def bits(t):
        out = 0.0
        for g in windows(t):
            key = 0
            for s in (0 if c == " " else quality.symbols(base.code_points(c))[0] for c in g):
                key = key * quality.SYMBOLS + int(s)
            out -= np.log2(p(g, 2.0 ** -(float(table[key]) + float(own_bits[ord(g[-1])]))))
        return out

    ids, dealt = quality._dealt(df, df.select("id").where("id < 16"))
    if wide:  # the workers have the module as it is
        rows = [(0, (quality._ID, str(i))) for i in range(16)] + dealt.collect()
        asked = spark.createDataFrame(list(quality._ask(0, iter(rows))), "kind int, part int, keys binary, counts binary")
        parts = 1
    else:
        asked, parts = spark.createDataFrame(ids.union(dealt).mapPartitionsWithIndex(quality._ask), "kind int, part int, keys binary, counts binary"), dealt.getNumPartitions()
    grams, classes = quality._counted(base.stored(asked, "asked"))
    assert {r.gram: r.c for r in grams.where("c > 0").collect()} == seen[n]
    assert {r.gram for r in grams.collect()} == {g for t in folded for g in windows(t)}
    assert sorted(map(tuple, classes.collect())) == sorted(map(tuple, counted.collect()))
    answers = quality._answers(grams, quality._character_levels(grams), parts)
    shared = spark.sparkContext.broadcast((table, own_bits))
    if wide:
        class Here:
            mapPartitions = staticmethod(lambda run: list(run(iter(rows[:16] + answers.collect() + rows[16:]))))

        got = quality._scores(Here, shared)
    else:
        got = quality._scores(ids.union(answers).union(dealt), shared).collect()
    assert len(got) == len(texts)
    for i, _, good, b, count in got:
        assert good == (i < 16) and count == len(folded[i])
        assert b == pytest.approx(bits(folded[i]), rel=1e-5, abs=1e-6), texts[i]


def test_parts_are_judged_alike(spark, sf, monkeypatch):
    """Neither the number of parts nor the size of steps changes a result; rows without an id and repeated ids stay apart."""
    docs = base.table(spark, sf, "documents").select("doc_id", "lang", "text").where("doc_id < 80")
    df = docs.union(docs.where("doc_id < 3").withColumn("text", F.lit("another text of this id"))).union(docs.selectExpr("CAST(NULL AS LONG)", "lang", "text").limit(5))
    good = docs.where("doc_id % 2 = 0").select(F.col("doc_id").cast("int"))
    results = []
    for parts, step in (("1", 1 << 20), ("7", 1000)):
        monkeypatch.setattr(quality, "STEP", step)
        monkeypatch.setattr(quality, "partitions", lambda _, n=int(parts): n)
        results.append(sorted((r.doc_id or -1, round(r.perplexity, 4), round(r.threshold, 4), r.kept) for r in quality.classify(df, good).collect()))
    assert results[0] == results[1] and len(results[0]) == df.count()


def test_good_documents_stay(spark, sf):
    labels = base.table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    got = quality.classify(base.table(spark, sf, "documents"), labels.where("quality = 1 AND toxic = 0")).join(labels, "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality == 1 and not r.toxic], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_quality_of_awkward_rows(docs):
    df, rows = docs
    got = quality.classify(df, df.where("doc_id % 2 = 0").union(df.limit(3))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None and not r.text:
            assert by_id[r.doc_id].perplexity is None and not by_id[r.doc_id].kept
    assert all(r.kept == (r.perplexity is not None) for r in quality.classify(df, df.limit(0)).collect())


# --- pages


@pytest.fixture(scope="module")
def field():
    return html.fit(html.labelled_pages())


def test_held_out_layouts(field):
    pages = html.labelled_pages(150, seed=77)
    labels = [html.viterbi(html._scores(field.index, field.weights, html.features(p)), field.moves) for p in pages]
    wrong = sum(y != b.label for p, ys in zip(pages, labels) for b, y in zip(p, ys))
    assert wrong <= 0.01 * sum(map(len, pages))


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(2)
    for n in range(1, 9):
        scores, moves = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        value = lambda ys: sum(scores[i, y] for i, y in enumerate(ys)) + sum(moves[a, b] for a, b in itertools.pairwise(ys))  # noqa: B023, E731
        every = list(itertools.product((0, 1), repeat=n))
        assert value(html.viterbi(scores, moves)) == pytest.approx(max(map(value, every)))
        weights = np.exp([value(y) for y in every])
        p, _ = html._marginals(scores, moves)
        assert p[:, 1] == pytest.approx(sum(w * np.array(y) for w, y in zip(weights, every)) / weights.sum())


BODY = "<article><h1>A  title &amp; more</h1><p>First paragraph, with <b>bold</b>&nbsp;words &lt;here&gt;.<p>Second one\nfollows, longer than the first.</article>"
TEXT = "A title & more\nFirst paragraph, with bold words <here>.\nSecond one follows, longer than the first."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav>{BODY}<footer>&copy; me</footer></body></html>",
        f"<BODY><script>var t='</p>';</script>{BODY}<form><label>Mail</label><input><button>Go</button></form>",
        f"<div class='sidebar'><ul><li><a href='#'>One</a><li><a href='#'>Two</a></ul></div>{BODY}<!-- <p>not shown</p> --><section id=comments><p>I liked it, thanks.</p></section>",
        f"<div class=cookie-banner><p>We use cookies, as you know.</p></div>{BODY}<div class='ad'>Buy things now, they are cheap.</div>",
    ],
)
def test_main_text(field, page):
    assert html.main_text(field, page) == TEXT


@pytest.mark.parametrize(
    "page",
    [
        f"<head><title>x</title><meta charset=utf-8>{BODY}",
        f"<html><head><title>x</title><template><div>no</div></template><link rel=a href=b>{BODY}</html>",
        f"<body><svg viewBox='0 0 1 1'/>{BODY}<svg><path d=a /></svg>",
        f"<body><svg><svg/><style/><text>no</text></svg><math/>{BODY}",
    ],
)
def test_hidden_elements_end(field, page):
    assert html.main_text(field, page) == TEXT


def test_text_of_formulas_stays(field):
    page = BODY.replace("words", "<math><mspace width=1 /><mi>x</mi><mo>=</mo><mn>2</mn></math> words")
    assert html.main_text(field, page) == TEXT.replace("words", "x=2 words")
    assert html._attributes("<svg a=b/>", 4)[2] is False and html._attributes('<svg a="b"/>', 4)[2] is True


def test_pages_of_the_tables(spark, sf):
    pages = base.table(spark, sf, "pages")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].n_chars == len(got[r.page_id].text) > 0 and "<" not in got[r.page_id].text


def test_awkward_pages(spark):
    made = [(1, None), (2, ""), (3, "<" * 2000), (4, "<a href='" * 500), (5, "plain"), (6, f"<article><p>{'word ' * 50000}</article>"), (6, "<p"), (None, "&#0;<!--")]
    df = spark.createDataFrame([(i, "u", h, "x", 5) for i, h in made], "page_id long, url string, html string, text string, n_chars long")
    got = html.extract(df).collect()
    assert len(got) == len(made) and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert html.extract(df.limit(0)).collect() == []


def test_no_rows(spark):
    none = spark.createDataFrame([], helpers.COLUMNS)
    assert bpe.decode(bpe.encode(none, rank_file()), rank_file()).collect() == []
    assert langid.identify(none, langid.train(none)).collect() == []
    assert quality.classify(none, none).collect() == []


def test_digest_columns(spark, sf, public):
    from tidewell.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in base.table(spark, sf, "documents").collect()}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    got = QUERIES["op4_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = public.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids)).encode()), digest(texts[r.doc_id].encode()))


PLAIN = {
    "en": [
        "The house is on the hill.", "She went to the market yesterday to buy some bread.", "It was the best of times, it was the worst of times.",
        "I don't know what you mean by that.", "Please send me the report before Friday.", "Water boils at one hundred degrees.",
        "He quickly realised that nothing would change.", "My brother plays football every weekend.", "The committee approved the new budget.",
        "Why would anyone want to live there?",
    ],
    "fr": ["La maison est sur la colline.", "Je ne sais pas ce que vous voulez dire.", "Nous allons à la plage demain matin.", "Le chat dort sur le canapé.", "Il fait très froid en hiver."],
    "de": ["Das Haus steht auf dem Hügel.", "Ich weiß nicht, was du meinst.", "Wir gehen morgen früh an den Strand.", "Die Katze schläft auf dem Sofa.", "Im Winter ist es sehr kalt."],
    "es": ["La casa está en la colina.", "No sé lo que quieres decir.", "Mañana vamos a la playa.", "El gato duerme en el sofá.", "Hace mucho frío en invierno."],
}
STRANGE = [
    "Дом стоит на холме.", "Я не знаю, что вы имеете в виду.", "Το σπίτι είναι στο λόφο.", "房子在山上。我不知道你的意思", "البيت على التل", "xqzv wkjp qzzx vbnm kjhg",
    "lkjw qpoz mxnb vczx wqer", "aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Qgb2YgYmFzZTY0", "TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24",
]


def test_plain_sentences_stay_and_what_is_no_learned_script_goes(spark, sf):
    model = langid.train(spark.read.parquet(f"{sf}/documents.parquet"))
    sentences = [t for texts in PLAIN.values() for t in texts]
    _, _, rejected = langid.predict(model, sentences + [t + " " + t for t in sentences])
    assert sum(rejected) <= 0.05 * len(rejected)
    assert all(langid.predict(model, STRANGE)[2])
    rng = np.random.default_rng(3)
    for words in (5, 20, 80):  # rejection of random letters by length
        texts = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäöüéèñ"), rng.integers(2, 9))) for _ in range(words)) for _ in range(100)]
        assert sum(langid.predict(model, texts)[2]) >= 90


def test_deep_nesting_takes_linear_time_and_changes_nothing():
    """A megabyte of elements that nothing closes, and what ends an open paragraph however many elements are inside."""
    for tag in ("<div>", "<b>", "<li>", '<p class="x">'):
        times = []
        for size in (250_000, 1_000_000):
            page = "<article><p>first</p>" + "".join(tag + "w " * (i % 50 == 0) for i in range(size // len(tag))) + "</article>"
            start = time.process_time()
            blocks = html.blocks_of(page)
            times.append(time.process_time() - start)
            assert blocks[0].text == "first"
        assert times[1] < 8 * times[0] + 0.5
    known = html.Known(frozenset(("article", "p")), frozenset())
    page = "".join(f"<x{i}><div></div>word" for i in range(60_000))
    start = time.process_time()
    assert len(html.blocks_of(page, known)) == 60_000 and time.process_time() - start < 30
    many = "<p>one" + "<b>" * 20 + "<div>two</div>"
    one, two = html.blocks_of(many)
    assert (one.text, two.text, two.own, sorted(two.tags)) == ("one", "two", "div", ["div"])
