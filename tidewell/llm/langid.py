"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its subwords: the runs of 2 to 4 characters within a word, whose
ends count as characters. Subwords are hashed into ``BUCKETS`` rows. The embeddings and the softmax are trained
by stochastic gradient descent in numpy, on a bounded sample of the labelled rows; the softmax is then given a
temperature. How far a text is of the learned languages at all is its familiarity: the share of its subwords of
three characters that training met (by a hash of ``WIDE`` values, so that few meet by chance), one added on either
side, so that a short text is not judged by two or three subwords. Pairs are nearly always met in any language of a
learned script, and quadruples seldom in a text of new words, so neither is counted. A text is rejected when its
familiarity is little more than that of texts of random letters: see ``_threshold``. The score is the best probability
times the familiarity.

Prediction runs in Arrow batches over the whole text. As the model is linear, each subword has one row of
scores per language, and a text costs one histogram of its subwords.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import LETTER, char_classes, code_points, tune

UNKNOWN = "und"
BUCKETS = 1 << 15
#: Values of the hash that tells whether training met a subword; a multiple of BUCKETS.
WIDE = 1 << 22
SIZES = (2, 3, 4)
#: Size of the subwords that familiarity counts.
FAMILIAR = 3
#: Characters that one numpy step sees; a longer text is read in pieces that overlap by the longest subword.
STEP = 1 << 20


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit. ``per_language`` rows of each language are drawn by a hash of their id,
    and of each ``words`` words in a row, at a place drawn the same way."""

    per_language: int = 600
    words: int = 96
    languages: int = 400
    dims: int = 16
    epochs: int = 12
    batch: int = 32
    rate: float = 0.5
    seed: int = 11
    kept: float = 0.999
    unlike: float = 0.99
    margin: float = 0.1


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    threshold: float
    met: np.ndarray  # bits of the WIDE values of the subwords that training met

    def number_met(self, keys: np.ndarray) -> int:
        return int(((self.met[keys >> 3] >> (keys & 7)) & 1).sum())


def subword_keys(points: np.ndarray, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    """Hashes below WIDE of all subwords of a text given as code points. Everything but letters ends a word."""
    if not len(points):
        return np.zeros(0, np.int64)
    letter = char_classes()[points] == LETTER
    c = np.concatenate([[0], np.where(letter, points, 0), [0]]).astype(np.uint64)
    inside = c != 0
    out = [np.zeros(0, np.int64)]
    for n in sizes:
        m = len(c) - n + 1
        if m <= 0:
            continue
        # Word ends may stand first or last only.
        good = inside[:m] | inside[1 : m + 1] if n == 2 else np.logical_and.reduce([inside[k : m + k] for k in range(1, n - 1)])
        at = np.flatnonzero(good)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ c[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append((h % np.uint64(WIDE)).astype(np.int64))
    return np.concatenate(out)


def subwords(points: np.ndarray) -> np.ndarray:
    """Buckets of all subwords of a text."""
    return subword_keys(points) % BUCKETS


def _pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    overlap = max(SIZES) - 1
    if len(points) <= STEP:
        yield points
        return
    letter = char_classes()[points] == LETTER
    start = 0
    while start < len(points):
        end = min(len(points), start + STEP)
        # Cut between words; a run of letters longer than a step is cut inside, at the cost of one false word end.
        gap = np.flatnonzero(~letter[start:end]) if end < len(points) else np.zeros(0, int)
        if len(gap) and gap[-1] > overlap:
            end = start + int(gap[-1]) + 1
        yield points[start:end]
        start = end


def histogram(points: np.ndarray) -> np.ndarray:
    """Counts of a whole text's subwords by bucket."""
    return sum(np.bincount(subwords(piece), minlength=BUCKETS) for piece in _pieces(points))


def familiarity(met: int, number: int) -> float:
    return (met + 1) / (number + 2)


def measure(model: Model, points: np.ndarray) -> tuple[np.ndarray, float]:
    """Histogram of a whole text, and its familiarity."""
    counts, met, n = np.zeros(BUCKETS, np.int64), 0, 0
    for piece in _pieces(points):
        counts += np.bincount(subwords(piece), minlength=BUCKETS)
        keys = subword_keys(piece, (FAMILIAR,))
        met += model.number_met(keys)
        n += len(keys)
    return counts, familiarity(met, n)


def _some_words(text: str, words: int, key: int) -> str:
    parts = text.split()
    at = key % max(1, len(parts) - words + 1)
    return " ".join(w[:64] for w in parts[at : at + words])


def sample(labelled: DataFrame, text: str, lang: str, id: str, settings: Training) -> list[tuple[str, str]]:
    """(language, words) of the drawn rows: at most languages x per_language x words, whatever the input.

    Rows are drawn by the smallest hashes. From the languages' counts follows a hash below which about four times
    as many rows as wanted lie; only those are sorted.
    """
    key = F.crc32(F.concat(F.lit("fit-"), F.col(f"`{id}`").cast("string")))
    known = labelled.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    counts = known.groupBy(F.col(f"`{lang}`").alias("lang")).count().orderBy(F.desc("count"), "lang").limit(settings.languages).collect()
    if not counts:
        return []
    below = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], int((4 * settings.per_language + 50) / r["count"] * 2**32))])
    rows = known.select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.coalesce(key, F.lit(0)).alias("key")
    ).where(F.col("key") < below[F.col("lang")])
    words = settings.words

    def cut(batches):
        for b in batches:
            keys = b.column("key").to_pylist()
            texts = [_some_words(t, words, k) for t, k in zip(b.column("text").to_pylist(), keys)]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), pa.array(texts, pa.string()), b.column("key")], ["lang", "text", "key"]
            )

    short = rows.mapInArrow(cut, "lang string, text string, key long")
    drawn = Window.partitionBy("lang").orderBy("key", "text")
    picked = (
        short.withColumn("n", F.row_number().over(drawn))
        .where(F.col("n") <= settings.per_language)
        .orderBy("lang", "n")
    )
    return [(r.lang, r.text) for r in picked.select("lang", "text").collect()]


def fit(examples: list[tuple[str, str]], settings: Training = Training()) -> Model:
    """Train on (language, words). Every fifth example is kept apart for the temperature and the threshold;
    there it is cut to lengths from one word up, as real texts have all lengths."""
    languages = tuple(sorted({lang for lang, _ in examples}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0, np.zeros(WIDE // 8, np.uint8))
    rng = np.random.default_rng(settings.seed)
    place = {lang: i for i, lang in enumerate(languages)}
    train, check, check_points, unlike = [], [], [], []
    met = np.zeros(WIDE, bool)
    letters = np.unique(np.concatenate([code_points(text.lower()) for _, text in examples]))
    letters = letters[char_classes()[letters] == LETTER]
    for i, (lang, text) in enumerate(examples):
        parts = text.split()
        if i % 5 == 4:
            parts = parts[: 1 + int(rng.integers(0, max(1, len(parts))))]
            unlike.append(_random_letters(code_points(" ".join(parts).lower()), letters, i))
        keys = subword_keys(code_points(" ".join(parts).lower()))
        if not len(keys):
            continue
        if i % 5 == 4:
            check.append((place[lang], keys % BUCKETS))
            check_points.append(code_points(" ".join(parts).lower()))
        else:
            train.append((place[lang], keys % BUCKETS))
            met[keys] = True
    check = check or train

    table = (rng.standard_normal((BUCKETS, settings.dims)) / settings.dims).astype(np.float64)
    weights = np.zeros((settings.dims, len(languages)))
    bias = np.zeros(len(languages))
    steps, step = max(1, settings.epochs * -(-len(train) // settings.batch)), 0
    seen = np.zeros(BUCKETS, bool)
    for _ in range(settings.epochs):
        order = rng.permutation(len(train))
        for a in range(0, len(train), settings.batch):
            part = [train[i] for i in order[a : a + settings.batch]]
            rate = settings.rate * (1 - step / steps)
            step += 1
            ids = np.concatenate([x for _, x in part])
            sizes = np.array([len(x) for _, x in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            seen[ids] = True
            hidden = np.add.reduceat(table[ids], starts, axis=0) / sizes[:, None]
            logits = hidden @ weights + bias
            error = softmax(logits)
            error[np.arange(len(part)), [y for y, _ in part]] -= 1
            back = error @ weights.T
            weights -= rate * hidden.T @ error
            bias -= rate * error.mean(axis=0)
            np.add.at(table, ids, -rate * np.repeat(back / sizes[:, None], sizes, axis=0) * np.sqrt(len(part)))
    table[~seen] = 0  # subwords that training never met say nothing

    scores = table @ weights
    logits = np.array([scores[x].mean(axis=0) + bias for _, x in check]) if check else np.zeros((0, len(languages)))
    truth = np.array([y for y, _ in check], int)
    temperature = _temperature(logits, truth)
    model = Model(languages, scores.astype(np.float32), bias, temperature, 0.0, np.packbits(met, bitorder="little"))
    like, random = (np.array([measure(model, p)[1] for p in texts if len(p)]) for texts in (check_points, unlike))
    return replace(model, threshold=_threshold(like, random, settings))


def _random_letters(points: np.ndarray, letters: np.ndarray, seed: int) -> np.ndarray:
    """The text with each letter replaced by one of ``letters``, all alike likely."""
    letter = char_classes()[points] == LETTER
    out = points.copy()
    out[letter] = np.random.default_rng(seed).choice(letters, int(letter.sum())) if len(letters) else 0
    return out


def _threshold(own: np.ndarray, random: np.ndarray, settings: Training) -> float:
    """A little over the familiarity that nearly all texts of random letters stay under, of all lengths that validation
    texts have: ``margin`` of the way to what nearly all validation texts reach, and never over that."""
    unlike = float(np.quantile(random, settings.unlike)) if len(random) else 0.0
    usual = float(np.quantile(own, 1 - settings.kept)) if len(own) else unlike
    return min(usual, unlike + settings.margin * (usual - unlike))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least validation loss, between 1/16 and 16."""
    if not len(logits):
        return 1.0
    tried = 2.0 ** np.linspace(-4, 4, 65)
    loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    langs, scores, rejected = [], [], []
    for t in texts:
        points = code_points((t or "").lower())
        has_letter = bool(len(points)) and bool((char_classes()[points] == LETTER).any())
        if not has_letter or not model.languages:
            langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
            continue
        counts, share = measure(model, points)
        logits = counts.astype(np.float32) @ model.scores / max(1, counts.sum()) + model.bias
        p = softmax(logits / model.temperature)
        best = int(p.argmax())
        langs.append(model.languages[best]), scores.append(float(min(1.0, p[best])) * share)
        rejected.append(share < model.threshold)
    return langs, scores, rejected


def held_out(doc_id):
    """Rows that no model may learn from: crc32 of the id as text, modulo 5, is 0. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", settings: Training = Training()) -> Model:
    tune(docs.sparkSession)
    return fit(sample(docs.where(~held_out(id)), text, lang, id, settings), settings)


def identify(docs: DataFrame, model: Model, text: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with the predicted language, its calibrated score (0 to 1) and whether it is rejected.

    A null text, or one without a letter (the empty one too), is ``und`` with score 0 and rejected; without any
    labelled row everything is. Columns of ``docs`` named as in ``out`` are replaced. Repeated rows are
    predicted alike. No rows give no rows.
    """
    spark = tune(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages floats, languages bounded by Training
    keep = [f for f in docs.schema.fields if f.name not in out]
    names = [f.name for f in keep]
    schema = T.StructType(
        [*keep, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType()), T.StructField(out[2], T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            langs, scores, rejected = predict(m, b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                schema.names,
            )

    inputs = docs.select(*[docs[f"`{c}`"].alias(f"_c{i}") for i, c in enumerate(names)], docs[f"`{text}`"].cast("string").alias("_text"))
    return inputs.mapInArrow(run, schema)
