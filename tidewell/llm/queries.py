"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import audit, bpe, chunks, exact, html, langid, packing, pii, quality, simhash, token_heap, topk, whitening
from tidewell.llm.base import ORACLE, QUERIES, query, table  # noqa: F401

#: Ranks of the tokenizer that encodes documents, in the installed package of public vocabularies.
RANKS = "byte_bpe_50k.tiktoken"
#: The tokenizer whose tokens are counted, and the context length they are held against.
TOKENIZER, CONTEXT = "byte_bpe_50k.json", 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, by a model trained on those that are not held out."""
    docs = table(spark, sf, "documents")
    model = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query(
    "op3_exact_dedup",
    f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents)
WINDOW same AS (PARTITION BY norm)""",
)
def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Copies of whole texts by content sort."""
    return exact.mark_copies(table(spark, sf, "documents"))


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """SimHash fingerprints and the groups that links of at most four bits make."""
    return simhash.group(table(spark, sf, "documents"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data and the terms that disclose it."""
    return pii.detect(table(spark, sf, "documents"))


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document, and the bytes that these decode to."""
    encoded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), rank_file())
    return bpe.decode(encoded, rank_file()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf, "pages").select("page_id", "url", "html"))


@query(
    "op9_exact_top_k",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10""",
)
def op9_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    return topk.search(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's tokens packed into sequences of 512 to 8192."""
    counted = bpe.token_counts(table(spark, sf, "documents").select("doc_id", "text"), rank_file(), "text", "n_tokens")
    return packing.best_fit(counted.drop("text"), "n_tokens")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Perplexity of every document under a model of those labelled good, and whether its language lets it pass."""
    good = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return quality.classify(table(spark, sf, "documents"), good.where("quality = 1 AND toxic = 0"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Passages that several documents share."""
    return chunks.repeated_passages(table(spark, sf, "documents"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is longer than a context."""
    counted = token_heap.count_tokens(table(spark, sf, "documents").select("doc_id", "text"), tokenizer_file())
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


@query(
    "op11_filter_audit",
    """
WITH flags AS (
  SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic FROM labels GROUP BY doc_id),
read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
failed AS (
  SELECT part, coalesce(f.good, 0) AS good, coalesce(f.toxic, 0) AS toxic,
    [(len(words) < 200)::INT, (100 * len(list_distinct(words)) < 50 * len(words))::INT,
     (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT,
     regexp_matches(text, '[#$%&*|]')::INT, coalesce(r.doc_id > min(r.doc_id) OVER (PARTITION BY text), false)::INT] AS f
  FROM read r LEFT JOIN flags f ON r.doc_id = f.doc_id),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) t(c, i)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a JOIN letters b ON b.i <> a.i JOIN letters c ON c.i NOT IN (a.i, b.i) JOIN letters d ON d.i NOT IN (a.i, b.i, c.i)
  JOIN letters e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
cells AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, f),
placed AS (  -- where each cell's rows leave in each order (6: never)
  SELECT part, filter_order, o, f, n, good, toxic, coalesce(list_position(list_transform(o, lambda i: f[i]), 1), 6) AS leaves FROM cells, orders),
steps AS (
  SELECT part, filter_order, s AS step, o[s] AS filter,
    sum(n) FILTER (leaves > s) AS kept, sum(n) FILTER (leaves = s) AS removed, sum(n) FILTER (leaves < s AND f[o[s]] = 1) AS redundant,
    sum(n) FILTER (f[o[s]] = 1 AND list_sum(f) = 1) AS unique_fails,
    sum(good) FILTER (leaves = s) AS good_lost, sum(toxic) FILTER (leaves = s) AS toxic_lost
  FROM placed, range(1, 6) r(s) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley
FROM steps""",
)
def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What five filters remove in every order of application, per source."""
    return audit.interactions(audit.masked(table(spark, sf, "documents"), table(spark, sf, "labels")))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding along the four components of largest deviation; a deviation beyond a long is null, and stands
    in ``deviation_exact`` only."""
    white = whitening.whiten(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return white.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.col("deviation").try_cast("long"))
