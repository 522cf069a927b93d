"""Fingerprints, result comparison, reconciliation over the given tables and changed copies of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import differences, matching, quality
from tidewell.operators.totals import union_labelled
from tidewell.sources.catalog import count_rows
from tidewell.suite.base import cents, query, table
from tidewell.workspace import scratch


@query(
    "quality_fingerprint",
    """SELECT 'reordered' AS version, count(*) AS rows, TRUE AS same FROM customer UNION ALL
       SELECT 'one value changed', count(*), FALSE FROM customer UNION ALL SELECT 'columns swapped', count(*), FALSE FROM customer UNION ALL
       SELECT 'row repeated', count(*) + 1, FALSE FROM customer""",
)
def quality_fingerprint(spark, sf):
    """Row order does not matter; a changed value, swapped columns and a repeated row do."""
    c = table(spark, sf, "customer").withColumn("note", F.lit(None).cast("string"))
    changed = c.withColumn("c_name", F.when(F.col("c_custkey") == 7, "x").otherwise(F.col("c_name")))
    swapped = c.withColumn("note", F.col("c_name")).withColumn("c_name", F.lit(None).cast("string"))
    versions = {
        "reordered": c.orderBy(F.col("c_name").desc()).select(*reversed(c.columns)),
        "one value changed": changed,
        "columns swapped": swapped,
        "row repeated": c.unionByName(c.where("c_custkey = 7")),
    }
    prints = union_labelled({n: quality.fingerprint(v) for n, v in versions.items()}, "version")
    wanted = quality.fingerprint(c).select(F.struct("rows", "hash_sum").alias("f")).scalar()
    return prints.select("version", "rows", (F.struct("rows", "hash_sum") == wanted).alias("same"))


@query(
    "quality_diff",
    """SELECT * FROM (VALUES ('count', 'match', ''), ('changed', 'mismatch', 'differ'), ('moved', 'mismatch', 'agree'), ('broken', 'error', ''),
                             ('unreadable', 'syntax', ''), ('absent', 'not run', '')) AS v(query, verdict, sums)
       WHERE EXISTS (SELECT 1 FROM orders)""",
)
def quality_diff(spark, sf):
    """Verdicts for results that match, differ, cancel out in the sums, failed, or were not run."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    plus = F.when(F.col("o_orderkey") % 2 == 0, 1.0).otherwise(0.0)
    total = F.when(F.col("o_orderkey") == 0, 5.0).when(F.col("o_orderkey") == 1, -5.0).otherwise(0.0)
    versions = {
        "count": o.orderBy("o_totalprice"),
        "changed": o.withColumn("o_totalprice", F.col("o_totalprice") + plus),
        "moved": o.withColumn("o_totalprice", F.col("o_totalprice") + total),
        "broken": o, "unreadable": o,
    }
    status = F.when(F.col("query") == "broken", "oom").when(F.col("query") == "unreadable", "syntax").otherwise("ok")
    results = union_labelled({n: quality.result_summary(v) for n, v in versions.items()}, "query").withColumn("status", status)
    names = spark.createDataFrame([(n,) for n in [*versions, "absent"]], "query string")
    wanted = quality.result_summary(o).select(F.struct("rows", "result_hash", "col_sums").alias("s")).scalar()
    reference = names.select("query", F.lit("ok").alias("status"), wanted.alias("s")).select("query", "status", "s.*")
    found = quality.verdicts(reference, results)
    sums = F.when(F.col("verdict") != "mismatch", "").when(F.col("column_off").isNull(), "agree").otherwise("differ")
    return found.select("query", "verdict", sums.alias("sums"))


@query(
    "quality_last_runs",
    """SELECT o_orderpriority AS query, max(o_orderkey) AS run FROM orders GROUP BY 1""",
)
def quality_last_runs(spark, sf):
    runs = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("query"), F.col("o_orderkey").alias("run"))
    return quality.last_runs(runs, ["query"], "run")


@query(
    "quality_agree",
    """WITH l AS (SELECT count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS v FROM lineitem)
       SELECT 'batch' AS source, n AS rows, v AS value, TRUE AS agree FROM l UNION ALL SELECT 'joined', n, v, TRUE FROM l UNION ALL SELECT 'parts', n, v, TRUE FROM l""",
)
def quality_agree(spark, sf):
    """The same rows reached three ways have to agree in count and weighted sum."""
    line = table(spark, sf, "lineitem")
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    odd = F.col("l_orderkey") % 2 == 1
    sources = {"batch": line, "joined": line.join(keys, "l_orderkey"), "parts": line.where(odd).unionByName(line.where(~odd))}
    return quality.agreement(sources, F.col("l_quantity").cast("bigint") * cents(F.col("l_extendedprice")))


@query(
    "quality_reconcile",
    """SELECT 'customer' AS "table", (SELECT count(*) FROM customer) AS rows, (SELECT count(*) FROM customer) AS expected_rows, 'ok' AS status UNION ALL
       SELECT 'orders', (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0), (SELECT count(*) FROM orders), 'rows_differ' UNION ALL
       SELECT 'part', (SELECT count(*) FROM part), NULL, 'ok' UNION ALL SELECT 'supplier', NULL, (SELECT count(*) FROM supplier), 'rows_differ'""",
)
def quality_reconcile(spark, sf):
    """A table lost rows, one has no expectation, one was not loaded."""
    t = {n: table(spark, sf, n) for n in ("customer", "orders", "part", "supplier")}
    found = count_rows({"customer": t["customer"], "orders": t["orders"].where("o_orderkey % 2 = 0"), "part": t["part"]})
    expected = count_rows({n: t[n] for n in ("customer", "orders", "supplier")})
    return quality.reconcile(found, expected)


@query(
    "quality_content",
    """SELECT c_custkey, md5('key=' || c_custkey || chr(31) || 'name=' || c_name || chr(31) || 'segment=' || c_mktsegment) AS content FROM customer""",
)
def quality_content(spark, sf):
    """MD5 per key of the sorted property pairs, from a map filled in another order."""
    props = F.map_from_arrays(
        F.array(F.lit("segment"), F.lit("key"), F.lit("name")),
        F.array(F.col("c_mktsegment"), F.col("c_custkey").cast("string"), F.col("c_name")),
    )
    return table(spark, sf, "customer").select("c_custkey", quality.content_hash(props).alias("content"))


@query(
    "quality_fields",
    """SELECT count(*) FILTER (WHERE c_custkey % 9 <> 0 AND c_custkey % 10 <> 0) AS matched, count(*) FILTER (WHERE c_custkey % 9 = 0 AND c_custkey % 10 <> 0) AS unexpected,
              count(*) FILTER (WHERE c_custkey % 10 = 0 AND c_custkey % 9 <> 0) AS missing,
              count(*) FILTER (WHERE c_custkey % 9 <> 0 AND c_custkey % 10 <> 0 AND c_custkey % 4 <> 0) AS c_name_ok,
              count(*) FILTER (WHERE c_custkey % 9 <> 0 AND c_custkey % 10 <> 0) AS c_mktsegment_ok FROM customer""",
)
def quality_fields(spark, sf):
    """Field-level match counts against an expected table; some rows are only on one side."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    actual = c.where("c_custkey % 10 <> 0").withColumn(
        "c_name", F.when(F.col("c_custkey") % 4 == 0, "?").otherwise(F.col("c_name"))
    )
    return matching.compare_with_expected(actual, c.where("c_custkey % 9 <> 0"), ["c_custkey"], ["c_name", "c_mktsegment"])


@query(
    "quality_maps",
    """SELECT o_orderkey, o_orderkey % 3 <> 0 AS same FROM orders""",
)
def quality_maps(spark, sf):
    """Maps compared whatever the order of their entries; every third has another value."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    one = F.create_map(F.lit("k"), key, F.lit("s"), status)
    other = F.create_map(F.lit("s"), status, F.lit("k"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(key, F.lit("!"))).otherwise(key))
    return table(spark, sf, "orders").select("o_orderkey", quality.same_map(one, other).alias("same"))


@query(
    "quality_locate",
    """SELECT o_orderkey, 'left' AS found, NULL AS columns FROM orders WHERE o_orderkey % 1000 = 1 UNION ALL
       SELECT o_orderkey, 'both', 'o_custkey,o_totalprice' FROM orders WHERE o_orderkey % 1000 = 2 UNION ALL
       SELECT -1 - o_orderkey, 'right', NULL FROM orders WHERE o_orderkey % 1000 = 3""",
)
def quality_locate(spark, sf):
    """Lost, changed and added rows of a copy, found by a hash tree: only leaves that differ are read again."""
    left, right = scratch(spark, "locate-left"), scratch(spark, "locate-right")
    o, key = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), F.col("o_orderkey")
    changed = o.where(key % 1000 != 1).withColumns(
        {c: F.when(key % 1000 == 2, F.col(c) + 1).otherwise(F.col(c)) for c in ("o_custkey", "o_totalprice")}
    )
    added = o.where(key % 1000 == 3).withColumn("o_orderkey", -1 - key)
    differences.store_hashed(o, left, ["o_orderkey"])
    differences.store_hashed(changed.unionByName(added), right, ["o_orderkey"])
    found = differences.locate(spark, left, right, o.schema, ["o_orderkey"])
    return found.withColumn("columns", F.array_join("columns", ","))
