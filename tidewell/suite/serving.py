"""Serving rollups, dashboard tiles, ad-hoc aggregation and point lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.text import minute
from tidewell.operators.totals import distinct_per_group
from tidewell.plans import serving
from tidewell.sources import lake
from tidewell.suite.base import CLICKSTREAM_SQL, clickstream, query
from tidewell.workspace import scratch


@query(
    "serve_user_stats",
    f"""WITH {CLICKSTREAM_SQL} SELECT user_id, count(*) AS events, CAST(sum(revenue) AS BIGINT) AS revenue, max(ts) AS last_ts
        FROM clicks GROUP BY user_id""",
)
def serve_user_stats(spark, sf):
    """Partials of two loads, merged: the same as one aggregation over all rows."""
    clicks = clickstream(spark, sf)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    parts = serving.user_stats(clicks.where(early)).unionByName(serving.user_stats(clicks.where(~early)))
    return serving.merge_user_stats(parts)


@query(
    "serve_point_lookup",
    f"""WITH {CLICKSTREAM_SQL}, one AS (
          SELECT count(*) AS events, CAST(sum(revenue) AS BIGINT) AS revenue, CAST(floor(epoch(max(ts))) AS BIGINT) AS last_ts
          FROM clicks WHERE user_id = 8)
        SELECT 'raw' AS arm, * FROM one UNION ALL SELECT 'rollup' AS arm, * FROM one""",
)
def serve_point_lookup(spark, sf):
    """One user from the raw events and from a rollup stored in user order with a bloom filter."""
    clicks, path = clickstream(spark, sf), scratch(spark, "user-stats")
    lake.export_sorted(serving.user_stats(clicks), path, "user_id", bloom=["user_id"])
    raw = serving.user_totals(clicks, 8).withColumn("arm", F.lit("raw"))
    rollup = serving.user_totals(spark.read.parquet(path), 8).withColumn("arm", F.lit("rollup"))
    return raw.unionByName(rollup)


@query(
    "serve_rollup_minute",
    f"""WITH {CLICKSTREAM_SQL} SELECT date_trunc('minute', ts) AS minute, country, device, event_type, count(*) AS events,
          CAST(sum(revenue) AS BIGINT) AS revenue, max(ts) AS newest FROM clicks GROUP BY ALL""",
)
def serve_rollup_minute(spark, sf):
    return serving.minute_rollup(clickstream(spark, sf)).drop("users")


@query(
    "serve_rollup_hour",
    f"""WITH {CLICKSTREAM_SQL} SELECT date_trunc('hour', ts) AS hour, country, device, event_type, count(*) AS events,
          CAST(sum(revenue) AS BIGINT) AS revenue, max(ts) AS newest FROM clicks GROUP BY ALL""",
)
def serve_rollup_hour(spark, sf):
    return serving.hour_rollup(serving.minute_rollup(clickstream(spark, sf))).drop("users")


_TILE_SQL_KEYS = {
    None: "''",
    "minute": "strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')",
    "hour": "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')",
}


def _tile_sql(with_users: bool) -> str:
    parts = []
    for t in serving.TILES:
        where = "".join(f" AND {c} = '{v}'" for c, v in t.where.items())
        users = "count(DISTINCT user_id)" if t.users else "CAST(NULL AS BIGINT)"
        columns = f", {users} AS users" if with_users else ""
        parts.append(
            f"SELECT '{t.name}' AS tile, {_TILE_SQL_KEYS.get(t.group, t.group)} AS key, count(*) AS events, "
            f"CAST(sum(revenue) AS BIGINT) AS revenue, CAST(floor(epoch(max(ts))) AS BIGINT) AS newest{columns} "
            f"FROM clicks, now_at WHERE ts >= as_of - INTERVAL {t.minutes} MINUTE{where} GROUP BY 1, 2 HAVING count(*) > 0"
        )
    body = " UNION ALL ".join(parts)
    return f"WITH {CLICKSTREAM_SQL}, now_at AS (SELECT date_trunc('minute', max(ts)) AS as_of FROM clicks) {body}"


def _as_of(clicks):
    return minute(clicks.agg(F.max("ts").alias("t")).scalar())


@query("serve_tiles_raw", _tile_sql(with_users=True))
def serve_tiles_raw(spark, sf):
    clicks = clickstream(spark, sf)
    return serving.tiles_from_events(clicks, _as_of(clicks))


@query("serve_tiles_rollup", _tile_sql(with_users=False))
def serve_tiles_rollup(spark, sf):
    clicks = clickstream(spark, sf)
    return serving.tiles_from_rollup(serving.minute_rollup(clicks), _as_of(clicks)).drop("users")


@query(
    "serve_uniq_merge",
    f"""WITH {CLICKSTREAM_SQL} SELECT country, count(DISTINCT user_id) AS users, TRUE AS merged_close, TRUE AS direct_close
        FROM clicks GROUP BY country""",
)
def serve_uniq_merge(spark, sf):
    """Sketches per minute merged per country, and a direct estimate: both within 5 % of the exact count."""
    clicks = clickstream(spark, sf)
    merged = serving.estimated_users(serving.minute_rollup(clicks), ["country"]).withColumnRenamed("users", "merged")
    direct = clicks.groupBy("country").agg(F.approx_count_distinct("user_id", 0.01).alias("direct"))
    exact = distinct_per_group(clicks, ["country"], "user_id", "users")
    near = lambda c: F.abs(F.col(c) - F.col("users")) <= F.greatest(F.lit(1.0), 0.05 * F.col("users"))
    return exact.join(merged, "country").join(direct, "country").select(
        "country", "users", near("merged").alias("merged_close"), near("direct").alias("direct_close")
    )


# (dimension, filters, start, end)
_GRID = (
    ("campaign_id", {}, "2024-01-01", "2024-01-31"),
    ("country", {"event_type": "purchase"}, "2024-01-01", "2024-01-31"),
    ("device", {"country": "KR", "event_type": "click"}, "2024-01-05", "2024-01-12"),
    ("event_type", {"country": "US", "device": "desktop"}, "2024-01-01", "2024-01-31"),
    ("hour", {"device": "mobile"}, "2024-01-10", "2024-01-12"),
)


def _adhoc_sql() -> str:
    parts = []
    for i, (dim, filters, start, end) in enumerate(_GRID):
        key = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')" if dim == "hour" else f"CAST({dim} AS VARCHAR)"
        where = "".join(f" AND {c} = '{v}'" for c, v in filters.items())
        parts.append(
            f"SELECT * FROM (SELECT {i} AS q, {key} AS k, count(*) AS c, CAST(sum(revenue) AS BIGINT) AS r, "
            f"count(DISTINCT user_id) AS u FROM clicks WHERE ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}'{where} "
            f"GROUP BY 2 ORDER BY c DESC, k LIMIT 100)"
        )
    return f"WITH {CLICKSTREAM_SQL} " + " UNION ALL ".join(parts)


@query("serve_adhoc", _adhoc_sql())
def serve_adhoc(spark, sf):
    clicks, out = clickstream(spark, sf), None
    for i, (dim, filters, start, end) in enumerate(_GRID):
        part = serving.adhoc(clicks, dim, filters, start, end, exact=True).withColumn("q", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "serve_latency_rollup",
    f"""WITH {CLICKSTREAM_SQL} SELECT date_trunc('day', ts) AS day, country, count(revenue) AS values, TRUE AS p50_close, TRUE AS p90_close, TRUE AS p99_close
        FROM clicks GROUP BY ALL""",
)
def serve_latency_rollup(spark, sf):
    """Quantile sketches per minute, merged to hours and these to days: each quantile's exact rank lies within three
    times the sketch's error of what was asked for."""
    clicks = clickstream(spark, sf)
    hours = serving.merge_quantiles(serving.quantile_rollup(clicks, "revenue"), [F.date_trunc("hour", "minute").alias("hour"), "country"])
    days = serving.merge_quantiles(hours, [F.date_trunc("day", "hour").alias("day"), "country"])
    shares = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    found = serving.quantiles(days, shares)
    # The exact ranks of the answers: shares of rows under and up to each of them.
    rows = clicks.select(F.date_trunc("day", "ts").alias("day"), "country", F.col("revenue").cast("double").alias("v")).where("v IS NOT NULL").join(found, ["day", "country"])
    slack = lambda n: 3 * serving.RANK_ERROR + 1 / n
    near = {
        f"{q}_close": (F.avg((F.col("v") < F.col(q)).cast("int")) <= p + slack(F.count("*"))) & (F.avg((F.col("v") <= F.col(q)).cast("int")) >= p - slack(F.count("*")))
        for q, p in shares.items()
    }
    out = rows.groupBy("day", "country", "values").agg(*[c.alias(n) for n, c in near.items()])
    return out.select(F.col("day").cast("timestamp_ntz").alias("day"), "country", "values", *near)
