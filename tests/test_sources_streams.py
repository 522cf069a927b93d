import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import checks
from tidewell.plans import game, serving
from tidewell.sources import catalog, export, files, generators, lake
from tidewell.streaming import jobs


def test_item_explode_edge_cases(spark):
    three = [{"item_id": 2506, "qty": 1, "price": 1100}, {"item_id": 71, "qty": 1, "price": 17600}, {"item_id": 4282, "qty": 2, "price": 11000}]
    rows = [
        (1, "purchase", json.dumps({"currency": "KRW", "items": three})),
        (2, "purchase", json.dumps({"items": []})),
        (3, "purchase", json.dumps({"duration_s": 3})),
        (4, "gacha", None),
        (5, "gacha", '{"items":[{"item_id":1'),
        (6, "gacha", json.dumps({"items": [{"item_id": 9, "qty": 2}]})),
        (7, "login", json.dumps({"items": three})),
    ]
    df = spark.createDataFrame(rows, "event_id int, event_type string, payload string")
    got = game.explode_items(df, keep=("event_id", "event_type")).collect()
    assert [(r.event_id, r.item_id, r.qty, r.price) for r in got if r.event_id != 6] == [(1, 2506, 1, 1100), (1, 71, 1, 17600), (1, 4282, 2, 11000)]
    assert [(r.item_id, r.qty, r.price) for r in got if r.event_id == 6] == [(9, 2, None)]


def test_explode_parses_each_payload_once_and_does_not_shuffle(spark, folder):
    generators.game_events(spark, "2026-10-01", 2, 50).write.parquet(folder + "/e")
    plan = game.explode_items(spark.read.parquet(folder + "/e"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "Exchange" not in plan and "PushedFilters: [In(event_type" in plan


def test_partition_pruning_and_column_pruning(spark, folder):
    lake.write_days(generators.game_events(spark, "2026-10-01", 4, 100), folder + "/t", "orc", sort=["event_type", "player_id"])
    day = lake.scan_lake(spark, folder + "/t", "orc", "2026-10-02", "2026-10-02")
    plan = day.groupBy("event_type").count()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "payload" not in plan
    inventory = lake.file_inventory(lake.scan_lake(spark, folder + "/t")).collect()
    assert len(inventory) == 4 and all(r.rows == 100 and r.bytes > 0 for r in inventory)


def test_rerun_replaces_only_the_days_written(spark, folder):
    events = generators.game_events(spark, "2026-10-01", 3, 40)
    lake.write_days(events, folder + "/t")
    lake.write_days(events.where("dt = '2026-10-02'").limit(5), folder + "/t")
    got = {str(r.dt): r["count"] for r in lake.scan_lake(spark, folder + "/t").groupBy("dt").count().collect()}
    assert got == {"2026-10-01": 40, "2026-10-02": 5, "2026-10-03": 40}


def test_publish_is_all_or_nothing(spark, folder):
    df = spark.range(10)
    lake.publish(df, folder)
    with pytest.raises(Exception):
        lake.publish(df.select(F.raise_error(F.lit("boom")).alias("id")), folder)
    assert lake.published(spark, folder).count() == 10
    lake.publish(df.limit(3), folder)
    assert lake.published(spark, folder).count() == 3
    lake.withdraw(spark, folder)
    assert lake.published(spark, folder) is None


def test_catalog(spark, folder):
    name = "t_" + os.path.basename(folder).replace("-", "_")
    assert [r.status for r in catalog.create_as(spark, name, spark.range(7)).collect()] == ["ok"]
    generators.clickstream(spark, "2026-10-01", 0, 30).write.orc(folder + "/x")
    assert catalog.external_table(spark, name + "_x", folder + "/x").count() == 30
    sales = spark.createDataFrame([(1, "2024-01-01", 5.0), (2, "2024-01-02", 2.0)], "id int, order_date string, price double")
    catalog.append_partitioned(sales, name + "_s", "order_date")
    catalog.append_partitioned(sales, name + "_s", "order_date")
    assert spark.table(name + "_s").where("order_date = '2024-01-02'").count() == 2
    names = {r.table for r in catalog.list_tables(spark).collect()}
    assert {name, name + "_x", name + "_s"} <= names
    target = T._parse_datatype_string("id BIGINT, order_date DATE, missing STRING")
    changes = {(r.column, r.change) for r in catalog.schema_changes(sales, target).collect()}
    assert changes == {("id", "type"), ("order_date", "type"), ("missing", "missing"), ("price", "dropped")}


def test_store_export_fails_rather_than_lose_rows(spark, folder):
    df = spark.range(60).withColumnRenamed("id", "user_id").coalesce(1)
    done = export.export_rows(df, export.file_store(folder), batch_rows=25).first()
    assert (done.rows, done.batches, done.retries) == (60, 3, 0)
    assert sum(len(open(f).readlines()) for f in glob.glob(folder + "/*.jsonl")) == 60
    with pytest.raises(Exception, match="1 of 25 rows not stored after 3 attempts"):
        export.export_rows(df, lambda: lambda rows: rows[:1], batch_rows=25, attempts=3, pause_seconds=0).collect()


def test_sorted_export_of_maps(spark, folder):
    df = spark.range(50).select(F.lit(1).alias("k"), F.create_map(F.lit("x"), F.col("id")).alias("m"))
    lake.export_sorted(df, folder + "/s", "k")
    assert spark.read.parquet(folder + "/s").count() == 50


def test_tsv_escapes(spark, folder):
    values = ["a\tb", "a\nb", "a\\nb", "\\", "\\N", "", None, "\\\\n", "한글\r"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    files.write_tsv(df, folder + "/t")
    got = {r.i: r.v for r in files.read_tsv(spark, folder + "/t", "i int, v string").collect()}
    assert got == dict(enumerate(values))


def _clicks(spark, folder, parts=3):
    df = generators.clickstream(spark, "2026-10-01", 0, 600).withColumn("revenue", (F.col("revenue") * 100).cast("bigint"))
    df.repartition(parts).write.parquet(folder + "/in")
    return df


def test_a_replayed_batch_overwrites_itself(spark, folder):
    df = _clicks(spark, folder)
    for _ in range(2):  # the same batch number twice, as after a failure between write and commit
        jobs.write_batch(serving.user_stats(df), folder + "/out", 7)
    state = jobs.read_batches(spark, folder + "/out", serving.user_stats(df).schema)
    assert state.agg(F.sum("events")).first()[0] == 600


def test_a_failed_stream_goes_on_where_it_stopped(spark, folder):
    df = _clicks(spark, folder)
    stream = lambda: jobs.file_stream(spark, folder + "/in", df.schema, "parquet", 1)
    calls = []

    def fragile(batch, n):
        calls.append(n)
        if n == 1 and calls.count(1) == 1:
            raise RuntimeError("lost")
        jobs.write_batch(batch, folder + "/out", n)

    with pytest.raises(Exception):
        jobs.run_once(stream().writeStream.foreachBatch(fragile), folder + "/cp")
    jobs.run_once(stream().writeStream.foreachBatch(fragile), folder + "/cp")
    assert jobs.read_batches(spark, folder + "/out", df.schema).count() == 600
    calls.clear()
    jobs.run_once(stream().writeStream.foreachBatch(fragile), folder + "/cp")
    assert calls == []


def test_the_run_log_has_every_batch(spark, folder):
    df, written = spark.range(3), []
    write = jobs.logged(lambda b, n: written.append(n), folder + "/log", "job")
    for n in [*range(101), 100]:  # the last batch is run again
        write(df, n)
    log = jobs.run_log(spark, folder + "/log")
    assert len(written) == 102 and {r.batch_id: r.read_rows for r in log.collect()} == dict.fromkeys(range(101), 3) and log.count() == 101


def test_late_rows_join_their_window(spark, folder):
    def put(rows, name):
        df = spark.createDataFrame(rows, "at string, kind string, v bigint").withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(folder + "/in/" + name)
        return df.schema

    schema = put([("2026-01-01 00:00:10", "a", 1), ("2026-01-01 00:05:00", "a", 1)], "1")

    def run():
        stream = jobs.file_stream(spark, folder + "/in/*", schema, "parquet")
        jobs.run_once(jobs.window_parts(stream, "at", "1 minute", ["kind"], "v", folder + "/out"), folder + "/cp")

    run()
    put([("2026-01-01 00:00:20", "a", 100), ("2026-01-01 00:09:00", "a", 1)], "2")
    run()
    parts = jobs.read_batches(spark, folder + "/out", "window_start TIMESTAMP, kind STRING, events BIGINT, total BIGINT")
    got = {str(r.window_start)[11:16]: (r.events, r.total) for r in jobs.merged_windows(parts, ["kind"]).collect()}
    assert got == {"00:00": (2, 101), "00:05": (1, 1), "00:09": (1, 1)}


def test_all_failures_are_kept(spark):
    with pytest.raises(checks.CheckFailed, match="60 failures, all of them in (.*)") as caught:
        checks.check_none(spark.range(60), "wrong")
    folder = str(caught.value).split(" in ")[1].split("\n")[0]
    assert spark.read.parquet(folder).count() == 60
    checks.check_none(spark.range(0), "wrong")
    assert spark.range(1).select(checks.require(F.col("id") == 0, "no")).first()[0] is True
    with pytest.raises(Exception, match="no"):
        spark.range(1).select(checks.require(F.lit(None).cast("boolean"), "no")).collect()


def test_tiles_from_rollup_equal_raw_on_the_minute(spark):
    df = generators.clickstream(spark, "2026-10-01", 0, 3000, span_seconds=86400).withColumn("revenue", (F.col("revenue") * 100).cast("bigint"))
    as_of = F.lit("2026-10-01 23:30:00").cast("timestamp")
    keys = ["tile", "key"]
    raw = serving.tiles_from_events(df, as_of).select(*keys, "events", "revenue", "newest")
    rolled = serving.tiles_from_rollup(serving.minute_rollup(df), as_of).select(*keys, "events", "revenue", "newest")
    assert raw.count() > 60 and raw.exceptAll(rolled).count() == 0 and rolled.exceptAll(raw).count() == 0
