"""Personal data: fixed patterns, and terms that disclose a protected value by how they co-occur with it.

Everything here is DataFrame expressions. A pattern's matches and the pieces between them come from two array
functions; running lengths give the positions. The patterns are possessive where that can't change a match, so
they take time in proportion to the text and no stack on long runs.

A protected value (an e-mail address, a number) seen in ``SUPPORT`` different texts or more has a probability
p(c) = documents with it / documents. A term of the same documents discloses it when the pointwise mutual
information log2(p(c,t) / (p(c) p(t))) reaches ``DISCLOSURE`` times the value's information -log2 p(c), that is,
when the term alone all but names the value. Term counts are over all documents; a term counts with a value
wherever both stand in the document. Disclosing terms are marked in every document, with the value or without,
and the sanitised text generalises them to a placeholder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.base import stored, tune

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", TERM: "[TERM]"}

SUPPORT = 3
DISCLOSURE = 0.9

_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# A local part starts where its run of characters starts, or where the match before ended within the run (\G):
# starts inside a run can match only if its start does.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Texts without this can't have a span of the kind; a quick test saves the two passes of the pattern.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]"}
WORD = r"\p{L}[\p{L}\p{N}]*+"

_SPAN = "array<struct<s:int,e:int,v:string>>"


def _rule(kind: str):
    return lambda found: _holds(kind, found)


def _of_kind(spans: Column, k: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["v"].alias("v")))


def _number_of(spans: Column, k: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _holds(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    digits = _digits(found)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(10, 15)



def matches(text: Column, pattern: str, holds) -> Column:
    """Spans (s, e, v) of the leftmost matches that ``holds`` accepts; code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.split(text, pattern, -1), found, lambda before, v: F.struct(F.length(before).alias("n"), v.alias("v"))
    )

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["n"]
        e = s + F.coalesce(F.length(x["v"]), F.lit(0))
        one = F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v"))).cast(_SPAN)
        out = F.when(x["v"].isNotNull() & holds(x["v"]), F.concat(acc["out"], one)).otherwise(acc["out"])
        return F.struct(e.alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """All pattern spans of a text, as (s, k, e, v) sorted by start and kind (k: its place in KINDS)."""
    found = []
    for k, kind in enumerate(KINDS):
        hinted = text.contains(HINTS[kind]) if kind == "email" else text.rlike(HINTS[kind])
        spans = F.when(hinted, matches(text, PATTERNS[kind], _rule(kind))).otherwise(F.array().cast(_SPAN))
        found.append(_of_kind(spans, k))
    return F.array_sort(F.concat(*found))


def _value(span: Column) -> Column:
    """What makes two mentions the same value: addresses without case, numbers without separators."""
    return F.concat_ws(
        ":", span["k"].cast("string"), F.when(span["k"] == 0, F.lower(span["v"])).when(span["k"] == 1, span["v"]).otherwise(_digits(span["v"]))
    )


def words(text: Column) -> Column:
    """Distinct words of two letters or more, lower case."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.length(w) > 1))


def _plain(docs: DataFrame, text: str) -> Column:
    return F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))


def disclosing_terms(docs: DataFrame, text: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(key, terms): for the MD5 of each text that holds some, the terms that disclose a value of any document.

    Copies of a text count as documents but not as different texts, so that a value copied with its text is
    not taken for one that the words around it name.
    """
    spark = tune(docs.sparkSession)
    plain = docs.select(_plain(docs, text).alias("t"))
    # Rows of one text are alike: what is counted per text is weighted with its copies.
    texts = stored(
        plain.withColumn("spans", base_spans(F.col("t")))
        .where(F.size("spans") > 0)
        .select(
            F.md5("t").alias("key"),
            F.array_distinct(F.transform("spans", _value)).alias("values"),
            words(masked(F.col("t"), F.col("spans"), F.lit("\n"))).alias("terms"),
        )
        .groupBy("key").agg(F.count(F.lit(1)).alias("w"), F.first("values").alias("values"), F.first("terms").alias("terms")),
        "texts",
    )
    valued = texts.select("key", "w", F.explode("values").alias("c"))
    protected = stored(
        valued.groupBy("c").agg(F.sum("w").alias("n_c"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support), "protected"
    )
    held = valued.join(protected.select("c"), "c", "left_semi").groupBy("key").agg(F.collect_set("c").alias("values"))
    pairs = stored(
        texts.select("key", "w", "terms").join(stored(held, "held"), "key")
        .select("w", "terms", F.explode("values").alias("c"))
        .select("w", "c", F.explode("terms").alias("t"))
        .groupBy("c", "t").agg(F.sum("w").alias("n_ct"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= support)
        .join(protected.select("c", "n_c"), "c"),
        "pairs",
    )
    candidates = stored(pairs.select("t").distinct(), "candidate-terms")
    n = plain.count()
    spread = (
        plain.select(F.explode(words(F.col("t"))).alias("t"))
        .join(candidates, "t", "left_semi")
        .groupBy("t").agg(F.count(F.lit(1)).alias("n_t"))
    )
    information = F.log2(F.lit(float(n)) / F.col("n_c"))
    mutual = F.log2(F.col("n_ct") * F.lit(float(n)) / (F.col("n_c") * F.col("n_t").cast("double")))
    disclosing = stored(
        pairs.join(spread, "t").where((information > 0) & (mutual >= disclosure * information)).select("t").distinct(), "disclosing"
    )
    worded = plain.select(F.md5("t").alias("key"), F.explode(words(F.col("t"))).alias("t"))
    return worded.join(disclosing, "t", "left_semi").groupBy("key").agg(F.collect_set("t").alias("terms"))


def _term_spans(text: Column, terms: Column, spans: Column) -> Column:
    """Places of the terms in a text, outside the pattern spans."""
    found = matches(text, WORD, lambda v: F.array_contains(terms, F.lower(v)))
    free = F.filter(found, lambda x: ~F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return _of_kind(free, len(KINDS))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as struct ``_row``, its text (null: empty) as ``_text``, ``_base`` spans and all spans ``_all``."""
    tune(docs.sparkSession)
    terms = stored(disclosing_terms(docs, text), "terms")
    rows = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("_row"), _plain(docs, text).alias("_text"))
    joined = rows.withColumn("key", F.md5("_text")).join(terms, "key", "left").withColumn("_base", base_spans(F.col("_text")))
    nothing = F.filter(F.col("_base"), lambda x: F.lit(False))
    added = F.when(F.col("terms").isNotNull(), _term_spans(F.col("_text"), F.col("terms"), F.col("_base"))).otherwise(nothing)
    return joined.withColumn("_all", F.array_sort(F.concat("_base", added))).drop("key", "terms")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def detect(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per row: its id, the number of spans of each kind, SHA-256 of the pattern spans and all spans as text.

    A null text counts as empty and has none. Repeated rows have the same spans; other columns are not read.
    No rows give no rows.
    """
    slim = docs.select(docs[f"`{id}`"].alias("_id"), docs[f"`{text}`"].alias("_t"))
    found = with_spans(slim, "_t")
    counts = [_number_of(F.col("_base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select(F.col("_row._id").alias(id), *counts, F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_all")).alias("spans"))


def masked(text: Column, spans: Column, label: Column | None = None) -> Column:
    """The text with each span replaced by its kind's placeholder, or by ``label``; spans that overlap become one."""
    labels = F.array(*[F.lit(LABELS[k]) if label is None else label for k in (*KINDS, TERM)])

    def step(acc: Column, x: Column) -> Column:
        piece = F.array(F.substr(text, acc["at"] + 1, x["s"] - acc["at"]), F.get(labels, x["k"]))
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], piece)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(
        spans, start, step, lambda acc: F.array_join(F.concat(acc["out"], F.array(F.substr(text, acc["at"] + 1, F.length(text)))), "")
    )


def sanitise(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced by placeholders, and ``length`` (if it is a
    column) set to the new number of characters. A text without spans, or null, stays as it is."""
    found = with_spans(docs, text)
    new = F.when(F.size("_all") > 0, masked(F.col("_text"), F.col("_all"))).otherwise(F.col(f"_row.`{text}`"))
    found = found.withColumn("_new", new)
    out = []
    for f in docs.schema.fields:
        old = F.col(f"_row.`{f.name}`")
        if f.name == text:
            out.append(F.col("_new").alias(f.name))
        elif f.name == length:
            out.append(F.when(F.size("_all") > 0, F.length("_new").cast(f.dataType)).otherwise(old).alias(f.name))
        else:
            out.append(old.alias(f.name))
    return found.select(*out)
