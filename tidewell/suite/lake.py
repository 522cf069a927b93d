"""Lake scans, JSON explode, day increments and the BI questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import days
from tidewell.operators.current import new_days
from tidewell.plans import game
from tidewell.sources import lake
from tidewell.suite.base import GAME_SQL, game_events, query, table
from tidewell.workspace import scratch


def _item_rows(spark: SparkSession, sf: str) -> DataFrame:
    return game.explode_items(game_events(spark, sf))


@query(
    "lake_explode_items",
    f"WITH {GAME_SQL} SELECT event_id, event_type, dt, item_id, qty, price FROM items",
)
def lake_explode_items(spark, sf):
    return _item_rows(spark, sf).select("event_id", "event_type", "dt", "item_id", "qty", "price")


def _events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))


@query(
    "lake_partition_inventory",
    """SELECT CAST(ts AS DATE) AS dt, count(*) AS rows, 1 AS has_files FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY 1""",
)
def lake_partition_inventory(spark, sf):
    path = scratch(spark, "inventory")
    lake.write_days(_events_by_day(spark, sf), path, "orc", sort=["event_type", "user_id"])
    days = lake.scan_lake(spark, path, "orc", "2024-01-10", "2024-01-16")
    found = lake.file_inventory(days)
    return found.select("dt", "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).cast("int").alias("has_files"))


@query(
    "lake_partition_overwrite",
    """SELECT CAST(ts AS DATE) AS dt, CAST(count(*) * (CASE WHEN day(ts) % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS rows
       FROM events GROUP BY CAST(ts AS DATE), day(ts)""",
)
def lake_partition_overwrite(spark, sf):
    """Even days are written again with doubled rows: they are replaced, odd days are untouched."""
    path, df = scratch(spark, "overwrite"), _events_by_day(spark, sf)
    lake.write_days(df, path)
    even = df.where(F.dayofmonth("ts") % 2 == 0)
    lake.write_days(even.unionByName(even), path)
    return lake.scan_lake(spark, path).groupBy("dt").agg(F.count("*").alias("rows"))


@query(
    "lake_increment_days",
    "SELECT CAST(ts AS DATE) AS dt, count(*) AS rows FROM events GROUP BY 1",
)
def lake_increment_days(spark, sf):
    """Load up to a day, then append newer days; the second run finds nothing to add."""
    source, target = scratch(spark, "days-source"), scratch(spark, "days-target")
    lake.write_days(_events_by_day(spark, sf), source, "parquet")
    full = lake.scan_lake(spark, source, "parquet")
    lake.write_days(full.where(F.col("dt") <= F.lit("2024-01-20").cast("date")), target, "parquet")
    for _ in range(2):
        loaded = lake.scan_lake(spark, target, "parquet")
        lake.append_days(new_days(full, loaded, "dt"), target, "parquet")
        spark.catalog.refreshByPath(target)
    return lake.scan_lake(spark, target, "parquet").groupBy("dt").agg(F.count("*").alias("rows"))


@query(
    "bi_dau",
    f"""WITH {GAME_SQL} SELECT dt, platform, count(DISTINCT player_id) AS dau FROM game
        WHERE dt BETWEEN '1997-03-01' AND '1997-03-07' GROUP BY dt, platform""",
)
def bi_dau(spark, sf):
    return game.daily_users(game_events(spark, sf), "1997-03-01", "1997-03-07")


@query(
    "bi_top_items",
    f"""WITH {GAME_SQL} SELECT item_id, CAST(sum(CAST(qty AS BIGINT) * price) AS BIGINT) AS revenue, count(*) AS n FROM items
        WHERE event_type = 'purchase' GROUP BY item_id ORDER BY revenue DESC, item_id LIMIT 10""",
)
def bi_top_items(spark, sf):
    return game.top_items(_item_rows(spark, sf))


@query(
    "bi_day_by_server",
    f"""WITH {GAME_SQL} SELECT event_type, server_id, count(*) AS n FROM game WHERE dt = '1998-06-15'
        GROUP BY event_type, server_id ORDER BY n DESC, event_type, server_id LIMIT 20""",
)
def bi_day_by_server(spark, sf):
    return game.day_by_server(game_events(spark, sf, players=False), "1998-06-15")


@query(
    "bi_top_spenders",
    f"""WITH {GAME_SQL} SELECT player_id, CAST(sum(CAST(qty AS BIGINT) * price) AS BIGINT) AS spend FROM items
        WHERE event_type IN ('purchase', 'gacha') GROUP BY player_id ORDER BY spend DESC, player_id LIMIT 20""",
)
def bi_top_spenders(spark, sf):
    return game.top_spenders(_item_rows(spark, sf))


@query(
    "bi_hourly",
    """SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND event_type = 'click' GROUP BY 1""",
)
def bi_hourly(spark, sf):
    events = _events_by_day(spark, sf).withColumnRenamed("ts", "event_time")
    return game.hourly_count(events, "2024-01-08", "2024-01-14", "click")


@query(
    "lake_late_days",
    """SELECT CAST(ts AS DATE) AS dt, count(*) AS rows, CAST(sum(CASE WHEN event_id % 97 = 0 THEN event_id + 1 ELSE event_id END) AS BIGINT) AS ids,
              CAST(ts AS DATE) <> DATE '2024-01-09' AND count(*) FILTER (WHERE event_id % 53 = 0 OR event_id % 97 = 0) > 0 AS written_again
       FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-09' OR event_id % 97 <> 0 GROUP BY 1""",
)
def lake_late_days(spark, sf):
    """Rows that come late for loaded days, corrected rows and rows taken away; one day is rewritten without a change.
    Only days that differ are written again, and the target ends equal to the source."""
    source, target, ledger = (scratch(spark, f"late-{n}") for n in ("source", "target", "ledger"))
    events = _events_by_day(spark, sf)
    calm = F.col("dt") == "2024-01-09"
    late = (F.col("event_id") % 53 == 0) & ~calm
    events.where(~late & ~(calm & (F.col("event_id") % 97 == 0))).write.partitionBy("dt").parquet(source)
    scan = lambda path: lake.scan_lake(spark, path, "parquet", schema=events.schema)
    days.reconcile(scan(source), target, ledger, 0)
    # The source changes: late rows, corrected ids, and the calm day laid out anew with the same rows.
    new = events.where(~(calm & (F.col("event_id") % 97 == 0))).withColumn("event_id", F.when((F.col("event_id") % 97 == 0), F.col("event_id") + 1).otherwise(F.col("event_id")))
    new.write.mode("overwrite").partitionBy("dt").parquet(source)
    spark.catalog.refreshByPath(source)
    written = days.reconcile(scan(source), target, ledger, 1).where("was_loaded").select("dt", F.lit(True).alias("_again"))
    spark.catalog.refreshByPath(target)
    held = scan(target).groupBy("dt").agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"))
    return held.join(written, "dt", "left").select(F.col("dt").cast("date").alias("dt"), "rows", "ids", F.coalesce("_again", F.lit(False)).alias("written_again"))
