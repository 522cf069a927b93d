"""The incremental jobs as file streams, run to completion, each compared with its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import masking
from tidewell.operators.current import latest, run_report
from tidewell.plans import game, serving
from tidewell.streaming import jobs, levels, sessions
from tidewell.suite.base import CLICKSTREAM_SQL, GAME_SQL, clickstream, game_events, query, table
from tidewell.suite.changes import LOG_SQL, change_log
from tidewell.workspace import scratch


def _tasks(spark: SparkSession) -> int:
    """As many files as the session has shuffle partitions: the input's width follows the cluster."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _half(spark: SparkSession) -> int:
    """Files of a batch, so that a stream has two."""
    return max(1, _tasks(spark) // 2)


def _files(df: DataFrame, path: str, fmt: str = "parquet") -> T.StructType:
    """The input laid out as files."""
    df.repartition(_tasks(df.sparkSession)).write.format(fmt).save(path)
    return df.schema


@query(
    "stream_ingest",
    """SELECT 'good' AS kind, event_type, count(*) AS rows FROM events WHERE event_id % 8 <> 0 GROUP BY 2
       UNION ALL SELECT 'bad', NULL, count(*) FROM events WHERE event_id % 8 = 0""",
)
def stream_ingest(spark, sf):
    """JSON messages with a nested object; broken ones go to the quarantine table. A second run finds nothing new."""
    root = scratch(spark, "ingest")
    message = F.to_json(
        F.struct("event_id", F.col("ts").alias("timestamp"), "user_id", "event_type", "value",
                 F.struct(F.lit("web").alias("source"), F.lit("1.0").alias("version")).alias("metadata"))
    )
    broken = F.when(F.col("event_id") % 8 == 0, F.substring(message, 1, 25)).otherwise(message)
    _files(table(spark, sf, "events").select(broken.alias("value")), f"{root}/in", "text")
    schema = T._parse_datatype_string(
        "event_id BIGINT, timestamp TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, metadata STRUCT<source: STRING, version: STRING>"
    )
    for _ in range(2):
        lines = jobs.message_stream(spark, {"path": f"{root}/in", "maxFilesPerTrigger": str(_half(spark))}, "text")
        jobs.run_once(jobs.ingest(jobs.parse_messages(lines, schema), f"{root}/good", f"{root}/bad"), f"{root}/checkpoint")
    good = jobs.read_batches(spark, f"{root}/good", schema).where("metadata.source = 'web'")
    bad = jobs.read_batches(spark, f"{root}/bad", "record STRING")
    return (
        good.groupBy("event_type").agg(F.count("*").alias("rows")).withColumn("kind", F.lit("good"))
        .unionByName(bad.agg(F.count("*").alias("rows")).withColumn("kind", F.lit("bad")), allowMissingColumns=True)
    )


def _click_stream(spark: SparkSession, sf: str, root: str) -> DataFrame:
    schema = _files(clickstream(spark, sf), f"{root}/in")
    return jobs.file_stream(spark, f"{root}/in", schema, "parquet", files_per_batch=_half(spark))


@query(
    "stream_rollup",
    f"""WITH {CLICKSTREAM_SQL} SELECT date_trunc('hour', ts) AS hour, country, device, event_type, count(*) AS events, CAST(sum(revenue) AS BIGINT) AS revenue,
          max(ts) AS newest FROM clicks GROUP BY ALL""",
)
def stream_rollup(spark, sf):
    """Partial minute rollups per batch, merged to hours at read."""
    root = scratch(spark, "rollup")
    stream = _click_stream(spark, sf, root)
    jobs.run_once(jobs.rollups(stream, f"{root}/minutes", f"{root}/users"), f"{root}/checkpoint")
    partial = serving.minute_rollup(clickstream(spark, sf)).schema
    return serving.hour_rollup(levels.read(spark, f"{root}/minutes", partial)).drop("users")


@query(
    "stream_user_stats",
    f"""WITH {CLICKSTREAM_SQL} SELECT user_id, count(*) AS events, CAST(sum(revenue) AS BIGINT) AS revenue, max(ts) AS last_ts FROM clicks GROUP BY 1""",
)
def stream_user_stats(spark, sf):
    root = scratch(spark, "user-rollup")
    stream = _click_stream(spark, sf, root)
    jobs.run_once(jobs.rollups(stream, f"{root}/minutes", f"{root}/users"), f"{root}/checkpoint")
    partial = serving.user_stats(clickstream(spark, sf)).schema
    return serving.merge_user_stats(levels.read(spark, f"{root}/users", partial))


@query(
    "stream_mask",
    """SELECT c_custkey, CASE WHEN c_acctbal < 3000 THEN left(c_name, 1) || '***' ELSE c_name END AS c_name, c_nationkey, c_acctbal,
              CASE WHEN NOT c_acctbal < 3000 THEN c_mktsegment END AS c_mktsegment, c_acctbal < 3000 AS is_masked FROM customer""",
)
def stream_mask(spark, sf):
    """Masked inside the stream; only masked rows are ever written."""
    root = scratch(spark, "mask")
    schema = _files(table(spark, sf, "customer"), f"{root}/in")
    mask = lambda df: masking.mask_rows(df, F.col("c_acctbal") < 3000, ["c_name"], ["c_mktsegment"])
    jobs.run_once(
        jobs.masked(jobs.file_stream(spark, f"{root}/in", schema, "parquet", _half(spark)), f"{root}/out", mask), f"{root}/checkpoint"
    )
    return jobs.read_batches(spark, f"{root}/out", mask(table(spark, sf, "customer")).schema)


@query(
    "stream_explode",
    f"""WITH {GAME_SQL} SELECT 'events' AS t, event_type, count(*) AS rows, CAST(0 AS BIGINT) AS value FROM game GROUP BY 2
        UNION ALL SELECT 'items', event_type, count(*), CAST(sum(CAST(qty AS BIGINT) * price) AS BIGINT) FROM items GROUP BY 2""",
)
def stream_explode(spark, sf):
    """Raw events and their items written from one pass over each batch."""
    root, events = scratch(spark, "explode"), game_events(spark, sf)
    schema = _files(events, f"{root}/in")
    stream = jobs.file_stream(spark, f"{root}/in", schema, "parquet", _half(spark))
    jobs.run_once(
        jobs.raw_and_derived(stream, f"{root}/events", {f"{root}/items": game.explode_items}), f"{root}/checkpoint"
    )
    raw = jobs.read_batches(spark, f"{root}/events", schema)
    items = jobs.read_batches(spark, f"{root}/items", game.explode_items(events).schema)
    counted = raw.groupBy("event_type").agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("value"))
    valued = items.groupBy("event_type").agg(F.count("*").alias("rows"), game.revenue().alias("value"))
    return counted.withColumn("t", F.lit("events")).unionByName(valued.withColumn("t", F.lit("items")))


@query("stream_cdc", f"WITH {LOG_SQL} SELECT o_orderkey, amount FROM newest WHERE deleted = 0")
def stream_cdc(spark, sf):
    """Backfill from the rows there at first, then follow; the latest rows equal the batch result."""
    root, log = scratch(spark, "cdc"), change_log(spark, sf)
    early = F.col("synced_at") < F.lit("2024-02-01").cast("timestamp_ntz")
    log.where(early).repartition(_tasks(spark)).write.parquet(f"{root}/in")
    for rest in (None, log.where(~early)):
        if rest is not None:
            rest.repartition(_tasks(spark)).write.mode("append").parquet(f"{root}/in")
        stream = jobs.file_stream(spark, f"{root}/in", log.schema, "parquet", _half(spark))
        jobs.run_once(jobs.append_changes(stream, f"{root}/out", ["o_orderkey"], "version"), f"{root}/checkpoint")
    state = latest(jobs.read_batches(spark, f"{root}/out", log.schema), ["o_orderkey"], "version", "deleted")
    return state.select("o_orderkey", "amount")


@query(
    "stream_windows",
    """SELECT date_trunc('minute', ts) AS window_start, event_type, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
       FROM events GROUP BY ALL""",
)
def stream_windows(spark, sf):
    """Event-time minute windows. Every second row comes a whole run later; it joins the window it belongs to."""
    root = scratch(spark, "windows")
    events = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )
    late = F.pmod(F.col("event_id"), F.lit(2)) == 0
    for rows in (events.where(~late), events.where(late)):
        rows.repartition(_tasks(spark)).write.mode("append").parquet(f"{root}/in")
        stream = jobs.file_stream(spark, f"{root}/in", events.schema, "parquet")
        jobs.run_once(jobs.window_parts(stream, "ts", "1 minute", ["event_type"], "cents", f"{root}/out"), f"{root}/checkpoint")
    parts = jobs.read_batches(spark, f"{root}/out", "window_start TIMESTAMP, event_type STRING, events BIGINT, total BIGINT")
    return jobs.merged_windows(parts, ["event_type"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _counted(spark: SparkSession, sf: str) -> str:
    root = scratch(spark, "counts")
    schema = _files(table(spark, sf, "events").select("event_id", "event_type"), f"{root}/in", "json")
    for _ in range(2):  # the second run finds nothing new
        stream = jobs.file_stream(spark, f"{root}/in", schema, "json", _half(spark))
        jobs.run_once(jobs.counts_by(stream, "event_type", f"{root}/out", f"{root}/log", "event counts"), f"{root}/checkpoint")
    return root


@query("stream_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def stream_counts(spark, sf):
    root = _counted(spark, sf)
    return jobs.merged_counts(jobs.read_batches(spark, f"{root}/out", "event_type STRING, count BIGINT"), "event_type")


@query("stream_run_log", "SELECT 'event counts' AS job, count(*) AS read_rows, count(*) AS written_rows, TRUE AS has_batches FROM events")
def stream_run_log(spark, sf):
    """What the run log says that the batches of a stream read and wrote, over two runs."""
    log = jobs.run_log(spark, f"{_counted(spark, sf)}/log").withColumn("written_rows", F.col("read_rows"))
    report = run_report(log)
    return report.select("job", "read_rows", "written_rows", (F.col("runs") >= 1).alias("has_batches"))


@query(
    "stream_levels",
    f"""WITH {CLICKSTREAM_SQL} SELECT user_id, count(*) AS events, CAST(sum(revenue) AS BIGINT) AS revenue, max(ts) AS last_ts, TRUE AS few_folders FROM clicks GROUP BY 1""",
)
def stream_levels(spark, sf):
    """Thirteen batches in levels of three, the last two sent again; at most two folders of each of three levels are live."""
    root, clicks, batches = scratch(spark, "levels"), clickstream(spark, sf), 13
    spread = clicks.withColumn("_batch", F.pmod(F.xxhash64("user_id", "ts"), F.lit(batches)))
    spread.write.partitionBy("_batch").parquet(f"{root}/in")
    schema = serving.user_stats(clicks).schema
    for b in (*range(batches), batches - 2, batches - 1):
        part = spark.read.schema(clicks.schema).parquet(f"{root}/in/_batch={b}")
        levels.add(serving.user_stats(part), b, f"{root}/users", serving.merge_user_stats, fan_out=3)
    folders = levels.live(spark, f"{root}/users")[1]
    merged = serving.merge_user_stats(levels.read(spark, f"{root}/users", schema))
    return merged.withColumn("few_folders", F.lit(len(folders) <= 2 * 3))


_GAP, _SLIDE, _PANES = 1800, 900, 4


@query(
    "stream_sessions",
    f"""WITH {CLICKSTREAM_SQL}, o AS (
          SELECT user_id, ts, revenue, CASE WHEN ts - lag(ts) OVER w <= INTERVAL {_GAP} SECOND THEN 0 ELSE 1 END AS opens FROM clicks
          WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM o)
        SELECT user_id, min(ts) AS started_at, max(ts) AS last_at, count(*) AS events, CAST(sum(revenue) AS BIGINT) AS total FROM s GROUP BY user_id, n""",
)
def stream_sessions(spark, sf):
    """Sessions with a gap of half an hour, from batches in which the rows of a session come apart and late."""
    root, clicks = scratch(spark, "sessions"), clickstream(spark, sf).select("user_id", "ts", "revenue")
    schema = _files(clicks, f"{root}/in")
    stream = jobs.file_stream(spark, f"{root}/in", schema, "parquet", files_per_batch=_half(spark))
    jobs.run_once(sessions.sessions(stream, "ts", _GAP, ["user_id"], "revenue", f"{root}/out"), f"{root}/checkpoint")
    parts = levels.read(spark, f"{root}/out", sessions.session_parts(clicks, "ts", _GAP, ["user_id"], "revenue").schema)
    return sessions.merge_sessions(parts, _GAP, ["user_id"])


@query(
    "stream_sliding",
    f"""WITH {CLICKSTREAM_SQL}, w AS (
          SELECT country, revenue, time_bucket(INTERVAL {_SLIDE} SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds({_SLIDE} * k) AS window_start
          FROM clicks, range({_PANES}) r(k))
        SELECT country, window_start, count(*) AS events, CAST(sum(revenue) AS BIGINT) AS total FROM w GROUP BY ALL""",
)
def stream_sliding(spark, sf):
    """Windows of an hour that start every quarter of an hour, per country."""
    root, clicks = scratch(spark, "sliding"), clickstream(spark, sf).select("country", "ts", "revenue")
    schema = _files(clicks, f"{root}/in")
    stream = jobs.file_stream(spark, f"{root}/in", schema, "parquet", files_per_batch=_half(spark))
    jobs.run_once(sessions.sliding(stream, "ts", _SLIDE, ["country"], "revenue", f"{root}/out"), f"{root}/checkpoint")
    panes = levels.read(spark, f"{root}/out", sessions.pane_parts(clicks, "ts", _SLIDE, ["country"], "revenue").schema)
    return sessions.sliding_windows(panes, _SLIDE, _PANES, ["country"])
