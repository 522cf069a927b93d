"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is of characters after the characters before them: n-grams of ``ORDER`` code points and their continuations, as
many as the trusted documents have. What these leave goes to a model of classes: the class of a character after the classes
of those before it (``SYMBOLS`` classes: letters without case, digits, kinds of punctuation; at most SYMBOLS^ORDER rows),
times the character itself within its class (at most a row per code point). So no two characters are taken for one, and a
character never met has a probability.

Texts are dealt out once, by id, to meet the trusted ids. Each part counts its own n-grams; their sums, continuation counts,
context totals and discounts come from joins sharded by n-gram, order by order. Each part then gets the probabilities of the
n-grams that it has, and no others, so neither a task nor the driver holds the model; only the two bounded tables of the
class model are sent to all executors.

A short text's perplexity is drawn to its language's mean by ``PRIOR`` characters' worth. A document is rejected when
its perplexity is over what a quantile of the trusted documents of its language have.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import LETTER, NUMBER, SPACE, char_classes, code_points, groups_of, partitions, stored, tune

SYMBOLS, ORDER = 40, 4
#: Number of n-grams of classes, and of code points.
GRAMS, POINTS = SYMBOLS**ORDER, 0x110000
QUANTILE = 0.99
#: A document passes up to this factor above the quantile's perplexity.
MARGIN = 1.1
PRIOR = 100.0
STEP = 1 << 20

_SPACE, _DIGIT, _LETTERS, _STOP, _END, _QUOTE, _SYMBOL = 0, 27, 28, 36, 37, 38, 39


def _classed(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, character) of each code point; a-z stand for A-Z, a space for all white space."""
    kinds = char_classes()[points]
    out = np.full(len(points), _SYMBOL, np.int64)
    small = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.int64)
    latin = (small >= 97) & (small <= 122)
    out[kinds == LETTER] = _LETTERS + small[kinds == LETTER] % 8
    out[latin] = small[latin] - 96
    out[kinds == NUMBER] = _DIGIT
    out[kinds == SPACE] = _SPACE
    out[np.isin(points, [ord(c) for c in ".,;:"])] = _STOP
    out[np.isin(points, [ord(c) for c in "!?"])] = _END
    out[np.isin(points, [ord(c) for c in "'\"()-«»“”’"])] = _QUOTE
    return out, np.where(out == _SPACE, ord(" "), small)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    return _classed(np.arange(POINTS, dtype=np.uint32))


def _read(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes and characters of texts that begin at ``starts``, and which are kept: runs of white space are one."""
    out, own = (table[points] for table in _tables())
    keep = np.ones(len(points), bool)
    keep[1:] = (out[1:] != _SPACE) | (out[:-1] != _SPACE)
    keep[starts] = True
    return out[keep], own[keep], keep


def symbols(points: np.ndarray) -> np.ndarray:
    """Class of each character; runs of white space are one."""
    return _read(points, np.arange(min(len(points), 1)))[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram of classes as a number, most recent last; the n-gram's characters; index of its text) of all characters of
    the texts. Before a text stands white space."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    classes, own, keep = _read(code_points("".join(texts)), starts[lengths > 0])
    owner = np.repeat(np.arange(len(texts)), lengths)[keep]
    lengths = np.bincount(owner, minlength=len(texts))
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key, characters = np.zeros(len(owner), np.int64), np.full((ORDER, len(owner)), ord(" "), np.int64)
    for back in range(ORDER - 1, -1, -1):
        inside = np.flatnonzero(place >= back)
        key *= SYMBOLS
        key[inside] += classes[inside - back]
        characters[ORDER - 1 - back, inside] = own[inside - back]
    return key, characters, owner


def count(docs: DataFrame, text: str) -> DataFrame:
    """(gram, c) over all texts: sums per task, then per shard. Numbers from GRAMS on are characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(GRAMS + POINTS, np.int64)
        for b in batches:
            texts = [t or "" for t in b.column("t").to_pylist()]
            for a, z in groups_of(texts, STEP):
                keys, characters, _ = ngrams(texts[a:z])
                sums[:GRAMS] += np.bincount(keys, minlength=GRAMS)
                sums[GRAMS:] += np.bincount(characters[-1], minlength=POINTS)
        seen = np.flatnonzero(sums)
        for a in range(0, len(seen), 1 << 16):
            at = seen[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["gram", "c"])

    return docs.select(docs[f"`{text}`"].cast("string").alias("t")).mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the numbers of n-grams seen 1 to 4 times."""
    n = {r.c: r.n for r in counts.where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n2, n3, n4 = (float(n.get(k, 0)) for k in range(1, 5))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5  # too few n-grams to tell
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.05), k) for x, k in zip(d, (0.95, 1.9, 2.9)))


def _level(counts: DataFrame, order: int, lower: DataFrame | None) -> DataFrame:
    """(gram, p, context, rest): interpolated probability of each n-gram seen at this order; rest is the weight that its
    context leaves to the lower order."""
    d1, d2, d3 = _discounts(counts)
    discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    rows = counts.withColumn("context", F.floor(F.col("gram") / SYMBOLS).cast("long")).withColumn("d", discount)
    totals = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
    joined = rows.join(totals, "context").withColumn("own", (F.col("c") - F.col("d")) / F.col("total")).withColumn("rest", F.col("left") / F.col("total"))
    if lower is None:
        return joined.select("gram", "context", "rest", (F.col("own") + F.col("rest") / SYMBOLS).alias("p"))
    below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
    return (
        joined.withColumn("suffix", F.col("gram") % SYMBOLS ** (order - 1))
        .join(below, "suffix")
        .select("gram", "context", "rest", (F.col("own") + F.col("rest") * F.col("below")).alias("p"))
    )


def train(trusted: DataFrame, text: str = "text") -> np.ndarray:
    """-log2 p of every n-gram of classes, by its number."""
    tune(trusted.sparkSession)
    return _gram_bits(stored(count(trusted, text), "ngrams"))


def _gram_bits(counted: DataFrame) -> np.ndarray:
    """Lower orders count the different classes seen before an n-gram. Without trusted text all n-grams are alike."""
    counts = {ORDER: counted.where(F.col("gram") < GRAMS)}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = counts[n + 1].select((F.col("gram") % SYMBOLS**n).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("c"))
    probability = np.full(SYMBOLS, 1.0 / SYMBOLS)
    lower = None
    for n in range(1, ORDER + 1):
        lower = stored(_level(counts[n], n, lower), f"order-{n}")
        found = lower.toArrow()  # at most SYMBOLS^n rows
        gram, context = found["gram"].to_numpy(), found["context"].to_numpy()
        rest = np.ones(SYMBOLS ** (n - 1))  # a context never seen leaves all to the lower order
        rest[context] = found["rest"].to_numpy()
        below = probability if n == 1 else np.tile(probability, SYMBOLS)
        probability = np.repeat(rest, SYMBOLS) * below
        probability[gram] = found["p"].to_numpy()
    return (-np.log2(np.maximum(probability, 1e-30))).astype(np.float32)


def _character_bits(counted: DataFrame) -> np.ndarray:
    """-log2 p of every character within its class, by code point: discounted counts, the rest shared by all of the class."""
    counts = counted.where(F.col("gram") >= GRAMS)
    found = counts.toArrow()  # at most one row per code point
    at, c = found["gram"].to_numpy() - GRAMS, found["c"].to_numpy().astype(float)
    kinds, characters = _classed(np.arange(POINTS, dtype=np.uint32))
    members = np.bincount(kinds[np.unique(characters)], minlength=SYMBOLS)
    cut = np.array(_discounts(counts))[np.minimum(c, 3).astype(int) - 1]
    total = np.bincount(kinds[at], weights=c, minlength=SYMBOLS)
    left = np.bincount(kinds[at], weights=cut, minlength=SYMBOLS)
    rest = np.where(total > 0, left / np.maximum(total, 1), 1.0) / np.maximum(members, 1)
    probability = rest[kinds]
    probability[at] += (c - cut) / total[kinds[at]]
    return -np.log2(probability[characters]).astype(np.float32)


# --- n-grams of characters ---------------------------------------------------------------------------------------
#
# What is dealt out by a number: trusted ids, answers to a part's questions and texts, in this order in every part.

_ID, _ANSWER, _TEXT = range(3)
#: Kinds of what a part counts.
_CHARACTERS, _CLASSES = range(2)
_CHUNK = 1 << 16


def _number(key: int) -> int:
    return key


def _dealt(rows: DataFrame, good_ids: DataFrame) -> tuple[RDD, RDD]:
    """Trusted ids and texts, both dealt by id; a row without an id is dealt by its text."""
    parts = partitions(rows.sparkSession)

    def packed(some: Iterator) -> Iterator:
        for r in some:
            text = (r.text or "").encode()
            yield zlib.crc32(text if r.name is None else r.name.encode()), (_TEXT, r.name, r.id, r.lang, zlib.compress(text, 1))

    name = F.col("id").cast(rows.schema["id"].dataType).cast("string").alias("name")
    ids = good_ids.select(name).where("name IS NOT NULL").rdd.map(lambda r: (zlib.crc32(r.name.encode()), (_ID, r.name)))
    texts = rows.select("id", "lang", "text", name).rdd.mapPartitions(packed)
    return ids.partitionBy(parts, _number), texts.partitionBy(parts, _number)


def _groups(rows: Iterator, good: set[str], answers: list) -> Iterator[list]:
    """Groups of (id, lang, whether it is trusted, text) of about STEP bytes; what comes before the texts is put into the lists."""
    group, size = [], 0
    for _, (kind, *r) in rows:
        if kind == _ID:
            good.add(r[0])
        elif kind == _ANSWER:
            answers.append(r)
        else:
            text = zlib.decompress(r[3])
            if group and size + len(text) > STEP:
                yield group
                group, size = [], 0
            group.append((r[1], r[2], r[0] in good, text.decode()))
            size += len(text)
    if group:
        yield group


def _letters(characters: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.bincount(characters.ravel(), minlength=POINTS))


def _coded(characters: np.ndarray, letters: np.ndarray) -> np.ndarray | None:
    """Each n-gram as one number, or None if that would not fit."""
    if len(letters) ** ORDER >= 2**63:
        return None
    at = np.zeros(POINTS, np.int64)
    at[letters] = np.arange(len(letters))
    key = np.zeros(characters.shape[1], np.int64)
    for line in characters:
        key = key * len(letters) + at[line]
    return key


def _different(characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams and the index of each one's among them."""
    letters = _letters(characters)
    key = _coded(characters, letters)
    if key is None:
        found, which = np.unique(characters, axis=1, return_inverse=True)
        return found, which.ravel()
    coded = pa.array(key).dictionary_encode()
    rest, lines = coded.dictionary.to_numpy(), []
    for _ in range(ORDER):
        rest, line = np.divmod(rest, len(letters))
        lines.append(letters[line])
    return np.stack(lines[::-1]), coded.indices.to_numpy()


def _strings(characters: np.ndarray) -> list[str]:
    whole = characters.T.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[i : i + ORDER] for i in range(0, len(whole), ORDER)]


def _finder(known: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Index among the known n-grams of n-grams that are all among them."""
    letters = _letters(known)
    keys = _coded(known, letters)
    keys = None if keys is None else pa.array(keys)

    def find(characters: np.ndarray) -> np.ndarray:
        if keys is not None:
            return pc.index_in(pa.array(_coded(characters, letters)), value_set=keys).to_numpy()
        n = known.shape[1]
        found, which = np.unique(np.concatenate([known, characters], axis=1), axis=1, return_inverse=True)
        place = np.zeros(found.shape[1], np.int64)
        place[which.ravel()[:n]] = np.arange(n)
        return place[which.ravel()[n:]]

    return find


def _ask(part: int, rows: Iterator) -> Iterator[tuple[int, int, bytes, bytes]]:
    """All n-grams of a part, with how often they are in its trusted texts; n-grams of classes of trusted texts alone."""
    good, seen, sums = set(), {}, np.zeros(GRAMS + POINTS, np.int64)
    for group in _groups(rows, good, []):
        keys, characters, owner = ngrams([t for *_, t in group])
        if len(keys):
            trusted = np.array([g for _, _, g, _ in group])[owner]
            found, which = _different(characters)
            for gram, c in zip(_strings(found), np.bincount(which, weights=trusted, minlength=found.shape[1]).astype(np.int64).tolist()):
                seen[gram] = seen.get(gram, 0) + c
            sums[:GRAMS] += np.bincount(keys[trusted], minlength=GRAMS)
            sums[GRAMS:] += np.bincount(characters[-1, trusted], minlength=POINTS)
    grams, counts = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
    at = np.flatnonzero(sums)
    for a in range(0, len(grams), _CHUNK):
        yield _CHARACTERS, part, "".join(grams[a : a + _CHUNK]).encode(), counts[a : a + _CHUNK].tobytes()
    for a in range(0, len(at), _CHUNK):
        yield _CLASSES, part, at[a : a + _CHUNK].tobytes(), sums[at[a : a + _CHUNK]].tobytes()


def _counted(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, c, parts) of characters, also of those in no trusted text, and (gram, c) of classes."""

    def characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, keys, counts in zip(*(b.column(c).to_pylist() for c in ("part", "keys", "counts"))):
                whole, c = keys.decode(), np.frombuffer(counts, np.int64)
                grams = [whole[i : i + ORDER] for i in range(0, len(whole), ORDER)]
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(np.full(len(c), part, np.int32)), pa.array(c)], ["gram", "part", "c"])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, counts in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, np.int64)) for x in (keys, counts)], ["gram", "c"])

    total = F.sum("c").alias("c")
    rows = asked.where(F.col("kind") == _CHARACTERS).mapInArrow(characters, "gram string, part int, c long")
    grams = stored(rows.groupBy("gram").agg(total, F.collect_list("part").alias("parts")), "grams")
    return grams, stored(asked.where(F.col("kind") == _CLASSES).mapInArrow(classes, "gram long, c long").groupBy("gram").agg(total), "ngrams")


def _character_levels(grams: DataFrame) -> DataFrame:
    """(gram, seen, rest) of every n-gram: its probability is ``seen`` plus ``rest`` times that of the class model."""

    def last(n: int, of: int):
        return F.substring("gram", of - n + 1, n).alias("gram")

    counts = {ORDER: grams.where("c > 0").select("gram", "c")}
    for n in range(ORDER - 1, 1, -1):
        counts[n] = stored(counts[n + 1].groupBy(last(n, n + 1)).agg(F.count(F.lit(1)).alias("c")), f"characters-{n}")
    lower = None
    for n in range(2, ORDER + 1):
        d1, d2, d3 = _discounts(counts[n])
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.substring("gram", 1, n - 1).alias("context")
        totals = counts[n].groupBy(context).agg(F.sum("c").alias("total"), F.sum(discount).alias("left"))
        met = counts[n].select("gram", (F.col("c") - discount).alias("kept"))
        asked = grams.select(last(n, ORDER)).distinct().select("gram", context, F.substring("gram", 2, n - 1).alias("suffix"))
        rows = asked.join(met, "gram", "left").join(totals, "context", "left")
        own = F.coalesce(F.col("kept") / F.col("total"), F.lit(0.0))
        rest = F.coalesce(F.col("left") / F.col("total"), F.lit(1.0))  # a context never seen leaves all to the lower order
        if lower is None:
            level = rows.select("gram", own.alias("seen"), rest.alias("rest"))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("seen").alias("below"), F.col("rest").alias("below_rest"))
            level = rows.join(below, "suffix").select("gram", (own + rest * F.col("below")).alias("seen"), (rest * F.col("below_rest")).alias("rest"))
        lower = stored(level, f"characters-order-{n}")
    return lower


def _answers(grams: DataFrame, levels: DataFrame, parts: int) -> RDD:
    """What each part asked for, dealt to it."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(some)
            rows = rows.take(pc.sort_indices(rows.column("part")))
            part, texts = rows.column("part").to_numpy(), rows.column("gram").to_pylist()
            seen, rest = (rows.column(c).to_numpy().astype(np.float32) for c in ("seen", "rest"))
            edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
                row = [part[a], "".join(texts[a:z]).encode(), seen[a:z].tobytes(), rest[a:z].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), *[pa.binary()] * 3))], ["part", "grams", "seen", "rest"])

        for b in batches:
            some.append(b)
            size += len(b)
            if size >= 1 << 20:
                yield from out()
                some, size = [], 0
        if size:
            yield from out()

    rows = grams.join(levels, "gram").select("gram", "seen", "rest", F.explode("parts").alias("part"))
    packets = rows.mapInArrow(packed, "part int, grams binary, seen binary, rest binary")
    return packets.rdd.map(lambda r: (r.part, (_ANSWER, bytes(r.grams), bytes(r.seen), bytes(r.rest)))).partitionBy(parts, _number)


def _scores(rows: RDD, shared) -> RDD:
    """(id, lang, whether it is trusted, sum of bits, number of characters) of every whole text."""

    def run(some: Iterator) -> Iterator[tuple]:
        table, own = shared.value
        good, answers, find = set(), [], None
        for group in _groups(some, good, answers):
            keys, characters, owner = ngrams([t for *_, t in group])
            if find is None and answers:
                whole = np.concatenate([code_points(a[0].decode()) for a in answers]).astype(np.int64)
                find = _finder(whole.reshape(-1, ORDER).T)
                seen, rest = (np.concatenate([np.frombuffer(a[i], np.float32) for a in answers]).astype(float) for i in (1, 2))
            bits = np.zeros(0)
            if len(keys):
                at = find(characters)
                bits = -np.log2(np.maximum(seen[at] + rest[at] * np.exp2(-(table[keys] + own[characters[-1]]).astype(float)), 1e-300))
            sums, lengths = np.bincount(owner, weights=bits, minlength=len(group)), np.bincount(owner, minlength=len(group))
            for (id, lang, trusted, _), b, n in zip(group, sums.tolist(), lengths.tolist()):
                yield id, lang, trusted, b, n

    return rows.mapPartitions(run)


def classify(docs: DataFrame, trusted: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id") -> DataFrame:
    """Per row: its id, ``perplexity`` per character, ``threshold`` of its language and whether it is ``kept``.

    ``trusted`` has the ids of the trusted documents; a null id is none. An empty or null text has no perplexity (null) and
    is not kept. A language without trusted documents, null too, is held to the threshold of all trusted documents
    together; without any, everything with text is kept. Repeated rows are judged alike. No rows give no rows.

    Texts move once, to meet the trusted ids; what is shuffled then serves for counting and for scoring.
    """
    spark = tune(docs.sparkSession)
    rows = docs.select(docs[f"`{id}`"].alias("id"), docs[f"`{lang}`"].alias("lang"), docs[f"`{text}`"].cast("string").alias("text"))
    good_ids = trusted.select(F.col(f"`{id}`").alias("id")).where("id IS NOT NULL").distinct()
    # Only the ids that documents have are dealt.
    ids, texts = _dealt(rows, stored(good_ids.join(rows.select("id"), "id", "left_semi"), "trusted"))
    asked = ids.union(texts).mapPartitionsWithIndex(_ask)
    asked = stored(spark.createDataFrame(asked, "kind int, part int, keys binary, counts binary", verifySchema=False), "asked")
    grams, classes = _counted(asked)
    answers = _answers(grams, _character_levels(grams), texts.getNumPartitions())
    shared = spark.sparkContext.broadcast((_gram_bits(classes), _character_bits(classes)))
    found = _scores(ids.union(answers).union(texts), shared)
    schema = T.StructType([rows.schema["id"], rows.schema["lang"], T.StructField("good", T.BooleanType()), T.StructField("bits", T.DoubleType()), T.StructField("n", T.LongType())])
    scored = stored(spark.createDataFrame(found, schema, verifySchema=False), "bits")
    good = scored.where("good AND n > 0")
    # Stored: its size is known then, so a small one is broadcast and a language's rows need not meet in one task.
    means = stored(good.groupBy("lang").agg((F.sum("bits") / F.sum("n")).alias("mean")), "means")
    overall = good.agg((F.sum("bits") / F.sum("n")).alias("mean_all"))
    spread = good.join(means, "lang").select("lang", ((F.col("bits") + PRIOR * F.col("mean")) / (F.col("n") + PRIOR)).alias("x"))
    # Quantiles by mergeable sketches over all trusted documents.
    limits = spread.groupBy("lang").agg(F.percentile_approx("x", QUANTILE, 10_000).alias("limit"))
    limit_all = spread.agg(F.percentile_approx("x", QUANTILE, 10_000).alias("limit_all"))
    common = overall.join(limit_all, F.lit(True)).select("mean_all", "limit_all").first()
    mean_all, limit_all = common if common else (None, None)
    log_margin = float(np.log2(MARGIN))
    per_language = stored(means.join(limits, "lang"), "thresholds")  # its size is known now, so a small one is broadcast
    x = (F.col("bits") + PRIOR * F.coalesce("mean", F.lit(mean_all), F.lit(0.0))) / (F.col("n") + PRIOR)
    limit = F.coalesce("limit", F.lit(limit_all).cast("double")) + log_margin
    return scored.join(per_language, "lang", "left").select(
        F.col("id").alias(id),
        F.when(F.col("n") > 0, F.pow(F.lit(2.0), x)).alias("perplexity"),
        F.pow(F.lit(2.0), limit).alias("threshold"),
        F.coalesce((F.col("n") > 0) & (x <= limit), F.col("n") > 0).alias("kept"),
    )
