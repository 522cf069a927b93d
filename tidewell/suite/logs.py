"""Log analytics over the events, and key exposure over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import epoch_seconds
from tidewell.operators import logs, matching
from tidewell.operators.totals import nearest_rank, union_matching
from tidewell.suite.base import cents, query, table


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


@query(
    "log_attribution",
    """WITH marks AS (SELECT user_id, ts, max(event_id) AS mark FROM events WHERE event_type = 'signup' GROUP BY user_id, ts)
       SELECT e.user_id, m.mark, e.event_type, count(*) AS n FROM events e ASOF JOIN marks m ON e.user_id = m.user_id AND e.ts >= m.ts GROUP BY ALL""",
)
def log_attribution(spark, sf):
    """Each event counted under the user's latest mark at that time."""
    events = _events(spark, sf)
    marks = events.where("event_type = 'signup'").groupBy("user_id", F.col("ts").alias("mark_at")).agg(
        F.max("event_id").alias("mark")
    )
    placed = matching.attribute_to_marks(events, marks, "ts", "mark_at", "mark", ["user_id"])
    return placed.groupBy("user_id", "mark", "event_type").agg(F.count("*").alias("n"))


@query(
    "log_attribution_all",
    """WITH marks AS (SELECT ts, max(event_id) AS mark FROM events WHERE event_type = 'error' GROUP BY ts)
       SELECT m.mark, e.event_type, count(*) AS n FROM events e ASOF JOIN marks m ON e.ts >= m.ts WHERE e.event_type <> 'error' GROUP BY ALL""",
)
def log_attribution_all(spark, sf):
    """One sequence of marks for all events; small groups, so hot buckets are split."""
    events = _events(spark, sf)
    marks = events.where("event_type = 'error'").groupBy(F.col("ts").alias("mark_at")).agg(F.max("event_id").alias("mark"))
    others = events.where("event_type <> 'error'")
    placed = matching.attribute_to_marks(others, marks, "ts", "mark_at", "mark", blocks=16)
    return placed.groupBy("mark", "event_type").agg(F.count("*").alias("n"))


@query(
    "log_mark_ends",
    """SELECT user_id, event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS ends_at FROM events WHERE event_type = 'signup'""",
)
def log_mark_ends(spark, sf):
    marks = _events(spark, sf).where("event_type = 'signup'").select("user_id", "event_id", "ts")
    return matching.mark_ends(marks, "ts", ["user_id"])




@query(
    "log_latency",
    """WITH e AS (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS v FROM events)
       SELECT event_type, count(*) AS n, avg(v) AS mean, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.9) AS p90, quantile_disc(v, 0.95) AS p95,
              quantile_disc(v, 0.99) AS p99, quantile_disc(v, 0.999) AS p999, max(v) AS max FROM e GROUP BY event_type""",
)
def log_latency(spark, sf):
    e = _events(spark, sf).select("event_type", cents(F.col("value")).alias("v"))
    return nearest_rank(e, ["event_type"], "v", logs.LATENCY_POINTS)


@query(
    "log_peak",
    """SELECT event_type, max(n) AS peak_per_s FROM (SELECT event_type, date_trunc('second', ts), count(*) AS n FROM events GROUP BY ALL) GROUP BY 1""",
)
def log_peak(spark, sf):
    return logs.peak_per_second(_events(spark, sf), ["event_type"], "ts")


@query(
    "log_benchmark",
    """WITH e AS (SELECT event_type AS run, ts, CAST(round(value * 100) AS BIGINT) AS us, event_id % 3 = 0 AS hit FROM events),
            s AS (SELECT run, max(n) AS peak_per_s FROM (SELECT run, date_trunc('second', ts), count(*) AS n FROM e GROUP BY ALL) GROUP BY 1)
       SELECT run, count(*) AS requests, avg(us) / 1000 AS mean_ms, quantile_disc(us, 0.5) / 1000 AS p50_ms, quantile_disc(us, 0.9) / 1000 AS p90_ms,
              quantile_disc(us, 0.95) / 1000 AS p95_ms, quantile_disc(us, 0.99) / 1000 AS p99_ms, quantile_disc(us, 0.999) / 1000 AS p999_ms,
              max(us) / 1000 AS max_ms, count(*) / 60.0::DOUBLE AS qps, count(*) FILTER (WHERE hit) / count(*) AS hit_ratio, any_value(peak_per_s) AS peak_per_s
       FROM e JOIN s USING (run) GROUP BY run""",
)
def log_benchmark(spark, sf):
    """The request log of benchmark runs: latency, rate, hit ratio, peak."""
    e = _events(spark, sf).select(
        F.col("event_type").alias("run"), "ts", cents(F.col("value")).alias("us"),
        (F.col("event_id") % 3 == 0).alias("hit"), F.lit(60.0).alias("duration_s"),
    )
    return logs.benchmark_summary(e, ["run"], "ts", "us", "hit", "duration_s")


@query(
    "log_staleness",
    """WITH a AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(date_trunc('minute', ts))) AS BIGINT) AS age FROM events WHERE event_id % 10 <> 0)
       SELECT event_type, count(*) AS answers, quantile_disc(age, 0.5) AS p50, quantile_disc(age, 0.99) AS p99, max(age) AS max FROM a GROUP BY 1""",
)
def log_staleness(spark, sf):
    """Answer time minus newest row; answers without a newest row are not counted."""
    a = _events(spark, sf).select(
        "event_type",
        epoch_seconds(F.col("ts")).alias("answered"),
        F.when(F.col("event_id") % 10 != 0, epoch_seconds(F.date_trunc("minute", "ts"))).alias("newest"),
    )
    return logs.staleness(a, ["event_type"], "answered", "newest")


@query(
    "log_exposure",
    """SELECT item_id, count(*) FILTER (WHERE contains(lower(d.text), lower(b.text))) AS hits FROM benchmark b, documents d GROUP BY item_id""",
)
def log_exposure(spark, sf):
    """In how many documents does each benchmark text occur, whole texts on both sides."""
    return matching.key_hits(
        table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "benchmark").select("item_id", "text"), "item_id", "text"
    )


@query(
    "log_exposure_report",
    """WITH k AS (SELECT item_id, lower(x) AS k FROM benchmark, (SELECT unnest([1, 2, 3]) AS i),
                 LATERAL (SELECT CASE i WHEN 1 THEN text WHEN 2 THEN left(text, 12) ELSE left(text, 3) END AS x)),
            h AS (SELECT k.item_id, k.k, count(*) FILTER (WHERE contains(lower(d.text), k.k)) AS hits FROM k, documents d GROUP BY ALL)
       SELECT count(*) AS keys_checked, count(*) FILTER (WHERE hits > 0) AS keys_found, max(hits) AS max_hits FROM h""",
)
def log_exposure_report(spark, sf):
    """Long, middle and very short keys: the whole texts and their first 12 and 3 letters."""
    b = table(spark, sf, "benchmark")
    k = b.select("item_id", F.explode(F.array("text", F.substring("text", 1, 12), F.substring("text", 1, 3))).alias("k"))
    keys = k.select(F.lower("k").alias("k"), "item_id").distinct()
    keys = keys.withColumn("key_id", F.concat_ws("/", F.col("item_id").cast("string"), "k"))
    hits = matching.key_hits(table(spark, sf, "documents"), "doc_id", "text", keys, "key_id", "k")
    return matching.exposure_report(hits)


@query("log_union_rotated", "SELECT event_type, count(*) AS n, CAST(count(*) FILTER (WHERE event_id % 2 = 1) AS BIGINT) AS rotated FROM events GROUP BY 1")
def log_union_rotated(spark, sf):
    """A log in two rotated tables, one with a column more, and a copy that must not be read."""
    e = _events(spark, sf)
    e.where("event_id % 2 = 0").select("event_id", "event_type").createOrReplaceTempView("tw_log")
    e.where("event_id % 2 = 1").select("event_id", "event_type", F.lit(1).alias("extra")).createOrReplaceTempView("tw_log_1")
    e.select("event_id", "event_type").createOrReplaceTempView("tw_log_copy")
    both = union_matching(spark, r"tw_log(_[0-9]+)?")
    return both.groupBy("event_type").agg(F.count("*").alias("n"), F.count("extra").alias("rotated"))


def _statements(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select(
        F.concat(F.lit("run-"), (F.col("user_id") % 7).cast("string"), F.lit("-"), F.col("event_id").cast("string")).alias("query_id"),
        F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string"), F.lit("-x")).alias("run_id"),
        F.concat(F.lit("host-"), (F.col("event_id") % 2).cast("string")).alias("hostname"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "signup", "QueryStart").when(F.col("event_type") == "error", "ExceptionBeforeStart").otherwise("QueryFinish").alias("type"),
        (cents(F.col("value")) * 10).alias("duration_ms"),
        F.col("event_id").alias("read_rows"),
        (F.col("event_id") * 1024).alias("read_bytes"),
        F.lit(0).cast("bigint").alias("written_rows"),
        (F.col("user_id") * 1000).alias("memory_usage"),
        F.create_map(F.lit("UserTimeMicroseconds"), F.col("event_id"), F.lit("CpuMicroseconds"), F.col("event_id") * 2).alias("counters"),
        F.when(F.col("event_type") == "error", (F.col("user_id") % 3 + 1).cast("int")).otherwise(0).alias("exception_code"),
    )


@query(
    "log_statements",
    """SELECT 'run-' || (user_id % 7) || '-' || event_id AS query_id, 'host-' || (event_id % 2) AS hostname, ts AS event_time,
              round(CAST(round(value * 100) AS BIGINT) / 100, 2) AS seconds, event_id AS read_rows,
              CASE WHEN event_id = 0 THEN '0 B' WHEN event_id < 1024 THEN printf('%.2f KiB', event_id * 1.0::DOUBLE)
                   ELSE printf('%.2f MiB', event_id / 1024.0::DOUBLE) END AS "read",
              CAST(0 AS BIGINT) AS written_rows,
              CASE WHEN user_id * 1000 < 1024 THEN (user_id * 1000) || ' B' WHEN user_id * 1000 < 1048576 THEN printf('%.2f KiB', user_id * 1000 / 1024.0::DOUBLE)
                   ELSE printf('%.2f MiB', user_id * 1000 / 1048576.0::DOUBLE) END AS memory,
              event_id * 2 AS "CpuMicroseconds", event_id / 1e6 AS cpu_user_s, CASE WHEN event_type = 'error' THEN CAST(user_id % 3 + 1 AS INTEGER) ELSE 0 END AS exception_code
       FROM events WHERE user_id % 7 <> 3 AND event_type <> 'signup'""",
)
def log_statements(spark, sf):
    return logs.statement_stats(_statements(spark, sf), "run-%", "run-3-%", ["CpuMicroseconds"])


@query(
    "log_run_stats",
    """WITH e AS (SELECT *, 's' || (user_id % 4) || '-x' AS run_id, event_type <> 'error' AS done, CAST(round(value * 100) AS BIGINT) * 10 AS ms,
                         CASE WHEN event_type = 'error' THEN user_id % 3 + 1 ELSE 0 END AS code FROM events WHERE event_type <> 'signup')
       SELECT run_id, count(*) FILTER (WHERE done) AS queries, count(*) FILTER (WHERE NOT done) AS failed, round(avg(ms) FILTER (WHERE done), 2) AS avg_ms,
              CAST(sum(event_id) AS BIGINT) AS read_rows, CAST(sum(event_id * 1024) AS BIGINT) AS read_bytes, CAST(sum(event_id * 2) AS BIGINT) AS cpu_us,
              count(DISTINCT event_id % 2) AS replicas, array_to_string(list_sort(list(DISTINCT code) FILTER (WHERE code <> 0)), ',') AS exception_codes
       FROM e WHERE regexp_matches(run_id, '^(s1|s2|s3)-') GROUP BY 1""",
)
def log_run_stats(spark, sf):
    """The approximate p99 is left out of the comparison."""
    stats = logs.run_stats(_statements(spark, sf), "^(s1|s2|s3)-").drop("p99_ms")
    return stats.withColumn("exception_codes", F.array_join("exception_codes", ","))


@query(
    "log_report",
    """WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), p AS (SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1)
       SELECT u.user_id, CASE WHEN u.user_id % 3 = 0 THEN u.n WHEN u.user_id % 3 = 1 THEN p.n END AS queries,
              CASE WHEN u.user_id % 3 = 0 THEN 'in run' WHEN u.user_id % 3 = 1 AND p.n IS NOT NULL THEN 'posthoc' ELSE 'none' END AS stats_from
       FROM u LEFT JOIN p USING (user_id)""",
)
def log_report(spark, sf):
    """Results of runs, statistics taken afterwards where there are none."""
    e = _events(spark, sf)
    results = e.groupBy("user_id").agg(F.count("*").alias("n")).select(
        "user_id", F.when(F.col("user_id") % 3 == 0, F.col("n")).alias("queries")
    )
    later = e.where("event_type <> 'view'").groupBy("user_id").agg(F.count("*").alias("queries"))
    return logs.fill_missing_stats(results, later.where("user_id % 3 = 1"), ["queries"], "user_id")


@query(
    "log_calls",
    """SELECT event_type AS name, 'agent of one long name, number ' || (user_id % 5) AS agent, count(*) AS calls FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY ALL""",
)
def log_calls(spark, sf):
    calls = _events(spark, sf).select(
        F.col("ts").alias("at"), F.col("event_type").alias("name"),
        F.concat(F.lit("agent of one long name, number "), (F.col("user_id") % 5).cast("string")).alias("agent"),
    )
    ntz = lambda t: F.lit(t).cast("timestamp_ntz")
    return logs.calls_by_caller(calls, ntz("2024-01-05"), ntz("2024-01-25"))


@query(
    "log_p99",
    """SELECT 's' || (user_id % 4) || '-x' AS run_id, TRUE AS near FROM events WHERE event_type NOT IN ('signup', 'error') AND user_id % 4 > 0 GROUP BY 1""",
)
def log_p99(spark, sf):
    """The approximate p99 of each run lies between the exact 98.5 and 99.5 percentiles."""
    statements = _statements(spark, sf)
    approximate = logs.run_stats(statements, "^(s1|s2|s3)-").where("p99_ms IS NOT NULL").select("run_id", "p99_ms")
    exact = nearest_rank(statements.where("type = 'QueryFinish'"), ["run_id"], "duration_ms", {"low": 0.985, "high": 0.995})
    return approximate.join(exact, "run_id").select("run_id", F.col("p99_ms").between(F.col("low"), F.col("high")).alias("near"))
