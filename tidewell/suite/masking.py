"""Masking over customers (row rule) and orders (JSON payloads, rule tables, patterns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import json_text
from tidewell.operators import masking
from tidewell.operators.totals import literal_rows
from tidewell.sources import lake
from tidewell.suite.base import query, table
from tidewell.workspace import scratch


def _users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with an unknown balance for one nation, so that the rule can be NULL."""
    return table(spark, sf, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_nationkey") != 3, F.col("c_acctbal"))
    )


def _rule():
    return F.col("c_acctbal") < 3000


_LETTER, _CLEARED = ["c_name"], ["c_mktsegment"]

USERS_SQL = """users AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer),
m AS (SELECT *, coalesce(c_acctbal < 3000, {null}) AS hit FROM users)"""

_MASKED_SQL = """SELECT c_custkey, CASE WHEN hit THEN left(c_name, 1) || '***' ELSE c_name END AS c_name, c_nationkey, c_acctbal,
  CASE WHEN NOT hit THEN c_mktsegment END AS c_mktsegment, hit AS is_masked FROM m"""


@query("mask_rows", f"WITH {USERS_SQL.format(null='FALSE')} {_MASKED_SQL}")
def mask_rows(spark, sf):
    return masking.mask_rows(_users(spark, sf), _rule(), _LETTER, _CLEARED)


@query("mask_rows_null_masks", f"WITH {USERS_SQL.format(null='TRUE')} {_MASKED_SQL}")
def mask_rows_null_masks(spark, sf):
    return masking.mask_rows(_users(spark, sf), _rule(), _LETTER, _CLEARED, null_masks=True)


@query(
    "mask_verify",
    f"""WITH {USERS_SQL.format(null='FALSE')} SELECT count(*) AS rows, count(*) FILTER (WHERE hit AND c_custkey % 17 <> 0) AS masked,
          count(*) FILTER (WHERE hit AND c_custkey % 17 = 0) AS rule_missed,
          count(*) FILTER (WHERE hit AND c_custkey % 17 <> 0 AND c_custkey % 19 = 0) AS leaks FROM m""",
)
def mask_verify(spark, sf):
    """Leak counters over a load with known faults: rows the mask missed, and a segment left in masked rows."""
    users = _users(spark, sf)
    good = masking.mask_rows(users.where(F.col("c_custkey") % 17 != 0), _rule(), _LETTER, _CLEARED)
    good = good.withColumn(
        "c_mktsegment", F.when((F.col("c_custkey") % 19 == 0) & F.col("is_masked"), "LEFT").otherwise(F.col("c_mktsegment"))
    )
    missed = users.where(F.col("c_custkey") % 17 == 0).withColumn("is_masked", F.lit(False))
    return masking.leak_report(good.unionByName(missed), _rule(), _LETTER, _CLEARED)


@query("mask_stored", f"WITH {USERS_SQL.format(null='FALSE')} {_MASKED_SQL}")
def mask_stored(spark, sf):
    """Loaded raw, then rewritten twice and published; the second rewrite changes nothing."""
    root = scratch(spark, "mask-stored")
    lake.publish(_users(spark, sf).withColumn("is_masked", F.lit(False)), root)
    for _ in range(2):
        lake.publish(masking.mask_stored(lake.published(spark, root), _rule(), _LETTER, _CLEARED), root)
    return lake.published(spark, root)


@query(
    "mask_residue",
    f"""WITH {USERS_SQL.format(null='FALSE')} SELECT 'first' AS version, count(*) FILTER (WHERE hit) AS raw_values, count(*) AS rows FROM m
        UNION ALL SELECT 'second', 0, count(*) FROM m""",
)
def mask_residue(spark, sf):
    """The version from before the rewrite still holds raw values in its files; the current one does not."""
    root = scratch(spark, "mask-residue")
    first = lake.publish(_users(spark, sf).withColumn("is_masked", F.lit(False)), root)
    lake.publish(masking.mask_stored(lake.published(spark, root), _rule(), _LETTER, _CLEARED), root)
    files = masking.residue(spark.read.parquet(f"{root}/data"), _rule(), "c_name")
    version = F.when(F.contains("file", F.lit(first)), "first").otherwise("second")
    return files.groupBy(version.alias("version")).agg(F.sum("raw_values").alias("raw_values"), F.sum("rows").alias("rows"))


# --- JSON fields -------------------------------------------------------------------------------------------
#
# Payload text is put together by hand, with spaces and a number like 12.50, to show that what is not removed
# keeps its text.


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    contact = F.concat(F.lit('{"phone":"010-'), cust, F.lit('","mail":"u'), cust, F.lit('@x.com"}'))
    many = F.concat(F.lit("["), contact, F.lit(',{"phone":"011","mail":"b"}]'))
    user = F.when(F.col("o_orderkey") % 3 == 0, many).when(F.col("o_orderkey") % 3 == 1, contact).otherwise(F.lit('"kim"'))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, "svc-core").otherwise("svc-edge").alias("service"),
        F.concat(F.lit("/api/"), (F.col("o_orderkey") % 5).cast("string")).alias("endpoint"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit('{ "id" : '), key, F.lit(" }")))
        .otherwise(F.concat(F.lit('{"secret":"s'), key, F.lit('","user":'), user, F.lit(',"amount":12.50,"id":'), key, F.lit("}")))
        .alias("req"),
    )


_BODY = """CASE o_orderkey % 3 WHEN 0 THEN '[{"phone":"010-'||o_custkey||'","mail":"u'||o_custkey||'@x.com"},{"phone":"011","mail":"b"}]'
  WHEN 1 THEN '{"phone":"010-'||o_custkey||'","mail":"u'||o_custkey||'@x.com"}' ELSE '"kim"' END"""
_BODY_NO_PHONE = """CASE o_orderkey % 3 WHEN 0 THEN '[{"mail":"u'||o_custkey||'@x.com"},{"mail":"b"}]'
  WHEN 1 THEN '{"mail":"u'||o_custkey||'@x.com"}' ELSE '"kim"' END"""
REQUESTS_SQL = f"""req AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'svc-core' ELSE 'svc-edge' END AS service,
         '/api/' || (o_orderkey % 5) AS endpoint, {_BODY} AS body, {_BODY_NO_PHONE} AS bare,
         o_orderkey % 7 = 0 AS small, '{{ "id" : ' || o_orderkey || ' }}' AS small_text,
         '"secret":"s' || o_orderkey || '",' AS secret, ',"amount":12.50,"id":' || o_orderkey || '}}' AS tail
  FROM orders)"""


@query(
    "mask_json_top",
    f"""WITH {REQUESTS_SQL} SELECT o_orderkey, CASE WHEN small THEN small_text ELSE '{{"user":' || body || tail END AS req FROM req""",
)
def mask_json_top(spark, sf):
    return _requests(spark, sf).select("o_orderkey", json_text.drop_keys(F.col("req"), ["secret", "absent"]).alias("req"))


@query(
    "mask_json_nested",
    f"""WITH {REQUESTS_SQL} SELECT o_orderkey, CASE WHEN small THEN small_text ELSE '{{' || secret || '"user":' || bare || tail END AS req
        FROM req""",
)
def mask_json_nested(spark, sf):
    paths = json_text.path_array([("user", "phone"), ("contact", "mail")])
    return _requests(spark, sf).select("o_orderkey", json_text.drop_paths(F.col("req"), paths).alias("req"))


def _rules(spark: SparkSession) -> DataFrame:
    """Rules for half of the (service, endpoint) pairs; one is there twice."""
    rows = [("svc-core", f"/api/{i}", "user", "phone") for i in (0, 1, 2)] + [("svc-edge", "/api/3", "user", "phone")]
    return literal_rows(spark, rows + rows[:1], "service string, endpoint string, class string, field string")


_RULED = "((service = 'svc-core' AND endpoint IN ('/api/0','/api/1','/api/2')) OR (service = 'svc-edge' AND endpoint = '/api/3'))"


@query(
    "mask_json_rules",
    f"""WITH {REQUESTS_SQL} SELECT o_orderkey, CASE WHEN small THEN small_text WHEN {_RULED} THEN '{{' || secret || '"user":' || bare || tail
          ELSE '{{' || secret || '"user":' || body || tail END AS req FROM req""",
)
def mask_json_rules(spark, sf):
    cleaned = masking.mask_json_by_rules(_requests(spark, sf), "req", _rules(spark), ["service", "endpoint"])
    return cleaned.select("o_orderkey", "req")


@query(
    "mask_json_left",
    f"""WITH {REQUESTS_SQL} SELECT 'before' AS stage, service, endpoint, count(*) AS rows FROM req
        WHERE NOT small AND o_orderkey % 3 <> 2 AND {_RULED} GROUP BY service, endpoint""",
)
def mask_json_left(spark, sf):
    """Rows a rule still applies to, before and after the removal; after it there are none."""
    raw, rules, keys = _requests(spark, sf), _rules(spark), ["service", "endpoint"]
    before = masking.json_fields_left(raw, "req", rules, keys).withColumn("stage", F.lit("before"))
    after = masking.json_fields_left(masking.mask_json_by_rules(raw, "req", rules, keys), "req", rules, keys)
    both = before.unionByName(after.withColumn("stage", F.lit("after")))
    return both.groupBy("stage", *keys).agg(F.count("*").alias("rows"))


@query(
    "mask_json_skip",
    f"""WITH {REQUESTS_SQL} SELECT o_orderkey, '{{"request":' || CASE WHEN small THEN small_text
          ELSE '{{' || secret || '"user":' || CASE WHEN o_orderkey % 3 = 1 THEN bare ELSE body END || tail END || ',"v":1}}' AS doc FROM req""",
)
def mask_json_skip(spark, sf):
    """One constant path for every row; arrays of objects keep theirs."""
    doc = F.concat(F.lit('{"request":'), F.col("req"), F.lit(',"v":1}'))
    return _requests(spark, sf).select("o_orderkey", json_text.skip_path(doc, ["request", "user", "phone"]).alias("doc"))


@query(
    "mask_json_paths",
    f"""WITH {REQUESTS_SQL}, p AS (
          SELECT 'id' AS path, 'number' AS type, count(*) AS n FROM req UNION ALL
          SELECT 'secret', 'string', count(*) FROM req WHERE NOT small UNION ALL
          SELECT 'amount', 'number', count(*) FROM req WHERE NOT small UNION ALL
          SELECT 'user', CASE o_orderkey % 3 WHEN 0 THEN 'array' WHEN 1 THEN 'object' ELSE 'string' END, count(*)
          FROM req WHERE NOT small GROUP BY 2)
        SELECT path, array_to_string(list_sort(list(type)), ',') AS types, CAST(sum(n) AS BIGINT) AS rows FROM p WHERE n > 0 GROUP BY path""",
)
def mask_json_paths(spark, sf):
    return json_text.list_paths(_requests(spark, sf), "req").select("path", F.array_join("types", ",").alias("types"), "rows")


@query(
    "mask_regex",
    """WITH r AS (SELECT o_orderkey, o_custkey, '/api/' || (o_orderkey % 5) AS ep FROM orders)
       SELECT o_orderkey,
         '{"m":{"phone":' || CASE WHEN ep IN ('/api/0','/api/1') THEN 'null' ELSE '"010-' || o_custkey || '"' END ||
         ',"acct":' || CASE WHEN ep IN ('/api/0','/api/1','/api/2') THEN 'null' ELSE CAST(o_custkey AS VARCHAR) END ||
         ',"request":"{\\"phone\\":' || CASE WHEN ep IN ('/api/0','/api/1') THEN 'null' ELSE '\\"a\\\\\\"b' || o_custkey || '\\"' END ||
         ',\\"x\\":1}"}}' AS raw FROM r""",
)
def mask_regex(spark, sf):
    """Keys nulled per endpoint in plain and in string-encoded JSON."""
    cust = F.col("o_custkey").cast("string")
    raw = F.concat(
        F.lit('{"m":{"phone":"010-'), cust, F.lit('","acct":'), cust,
        F.lit(',"request":"{\\"phone\\":\\"a\\\\\\"b'), cust, F.lit('\\",\\"x\\":1}"}}'),
    )
    endpoint = F.concat(F.lit("/api/"), (F.col("o_orderkey") % 5).cast("string"))
    rules = [("/api/0", "phone"), ("/api/0", "acct"), ("/api/1", "phone"), ("/api/1", "acct"), ("/api/2", "acct"), ("/api/2 ", "acct")]
    rows = table(spark, sf, "orders").select("o_orderkey", endpoint.alias("endpoint"), raw.alias("raw"))
    nulled = masking.null_fields(rows, "raw", literal_rows(spark, rules, "endpoint string, key string"))
    return nulled.select("o_orderkey", "raw")


_DEEP = 60


@query(
    "mask_json_deep",
    f"""WITH d AS (SELECT o_orderkey, repeat('{{"a":[', CAST(o_orderkey % {_DEEP} AS INTEGER)) || '1.50' ||
               repeat(']}}', CAST(o_orderkey % {_DEEP} AS INTEGER)) AS deep FROM orders)
        SELECT o_orderkey, '{{"user":[{{"d":' || deep || ',"name":"a"}}],"amount":12.50}}' AS req, FALSE AS left_over FROM d""",
)
def mask_json_deep(spark, sf):
    """A sensitive field beside values nested up to 60 levels of objects and arrays, and the check after it.

    The rows are dealt out first: a file of keys that is one task to read is much work to cut."""
    depth = (F.col("o_orderkey") % _DEEP).cast("int")
    deep = F.concat(F.repeat(F.lit('{"a":['), depth), F.lit("1.50"), F.repeat(F.lit("]}"), depth))
    raw = F.concat(F.lit('{"user":[{"phone":"010","d":'), deep, F.lit(',"name":"a"}],"amount":12.50}'))
    paths = json_text.path_array([("user", "phone")])
    dealt = table(spark, sf, "orders").select("o_orderkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    cleaned = dealt.select("o_orderkey", json_text.drop_paths(raw, paths).alias("req"))
    return cleaned.withColumn("left_over", json_text.has_path(F.col("req"), paths))
