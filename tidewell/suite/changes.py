"""Change log over orders: latest rows, increments, verification, lag, updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import current, matching
from tidewell.sources import commits, lake
from tidewell.suite.base import cents, query, table
from tidewell.workspace import scratch


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every order once, every 10th updated, every 25th deleted later."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")

    def version(n: int, month: int, amount, deleted: int) -> DataFrame:
        arrived = F.timestamp_seconds(
            F.unix_timestamp(F.to_timestamp(F.lit(f"2024-{month:02d}-01 00:00:00"))) + key % 86400
        ).cast("timestamp_ntz")
        return o.select(
            "o_orderkey",
            "o_custkey",
            amount.alias("amount"),
            F.lit(n).cast("bigint").alias("version"),
            F.lit(deleted).alias("deleted"),
            arrived.alias("synced_at"),
        )

    base = cents(F.col("o_totalprice"))
    return (
        version(0, 1, base, 0)
        .unionByName(version(1, 2, base + 100, 0).where(key % 10 == 0))
        .unionByName(version(2, 3, base, 1).where(key % 25 == 0))
    )


LOG_SQL = """log AS (
  SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) + x.extra AS amount, x.version, x.deleted,
         x.start + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS synced_at
  FROM orders, (VALUES (0, 1, 0, 0, TIMESTAMP '2024-01-01'), (1, 10, 100, 0, TIMESTAMP '2024-02-01'),
                       (2, 25, 0, 1, TIMESTAMP '2024-03-01')) AS x(version, every, extra, deleted, start)
  WHERE o_orderkey % x.every = 0),
newest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)"""


@query("cdc_latest", f"WITH {LOG_SQL} SELECT o_orderkey, o_custkey, amount, CAST(version AS BIGINT) AS version, deleted FROM newest")
def cdc_latest(spark, sf):
    return current.latest(change_log(spark, sf), ["o_orderkey"], "version").drop("synced_at")


@query(
    "cdc_latest_by_rank",
    f"""WITH {LOG_SQL} SELECT CAST(version AS BIGINT) AS version, count(*) AS rows, CAST(sum(amount) AS BIGINT) AS amount
        FROM newest GROUP BY version""",
)
def cdc_latest_by_rank(spark, sf):
    ranked = current.latest_by_rank(change_log(spark, sf), ["o_orderkey"], "version")
    return ranked.groupBy("version").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


@query("cdc_apply", f"WITH {LOG_SQL} SELECT o_orderkey, o_custkey, amount FROM newest WHERE deleted = 0")
def cdc_apply(spark, sf):
    live = current.latest(change_log(spark, sf), ["o_orderkey"], "version", "deleted")
    return live.select("o_orderkey", "o_custkey", "amount")


_CUT = "2024-02-01 12:00:00"
# What was loaded: everything that arrived before the cut, except some rows that were committed late.
_LOADED = f"synced_at < TIMESTAMP '{_CUT}' AND o_orderkey % 7 <> 0"


def _loaded(log: DataFrame) -> DataFrame:
    return log.where((F.col("synced_at") < F.lit(_CUT).cast("timestamp_ntz")) & (F.col("o_orderkey") % 7 != 0))


@query(
    "cdc_increment",
    f"""WITH {LOG_SQL}, mark AS (SELECT max(synced_at) AS mark_at FROM log WHERE {_LOADED})
        SELECT CAST(version AS BIGINT) AS version, count(*) AS rows, count(DISTINCT o_orderkey) AS keys
        FROM log, mark WHERE ({_LOADED}) OR synced_at >= mark_at - INTERVAL 1 MINUTE GROUP BY version""",
)
def cdc_increment(spark, sf):
    """Two increments over a stored target; the second one adds nothing, late rows inside the overlap are found."""
    source, target = scratch(spark, "cdc-source"), scratch(spark, "cdc-target")
    change_log(spark, sf).write.parquet(source)
    log = spark.read.parquet(source)
    _loaded(log).write.parquet(target)
    for _ in range(2):
        held = spark.read.parquet(target)
        current.increment(log, held, ["o_orderkey", "version"], "synced_at").write.mode("append").parquet(target)
    return spark.read.parquet(target).groupBy("version").agg(
        F.count("*").alias("rows"), F.count_distinct("o_orderkey").alias("keys")
    )


@query(
    "cdc_first_load",
    f"WITH {LOG_SQL} SELECT CAST(version AS BIGINT) AS version, count(*) AS rows FROM log GROUP BY version",
)
def cdc_first_load(spark, sf):
    """An empty target starts at the epoch: the first increment loads everything."""
    log = change_log(spark, sf)
    fresh = current.increment(log, log.where("false"), ["o_orderkey", "version"], "synced_at")
    return fresh.groupBy("version").agg(F.count("*").alias("rows"))


@query(
    "cdc_verify",
    """SELECT CAST(count(*) FILTER (WHERE o_orderkey % 25 <> 0) AS BIGINT) AS expected_live,
              CAST(count(*) FILTER (WHERE o_orderkey % 25 <> 0 OR o_orderkey % 50 = 0) AS BIGINT) AS rows,
              CAST(count(*) FILTER (WHERE o_orderkey % 11 = 0 AND (o_orderkey % 25 <> 0 OR o_orderkey % 50 = 0)) AS BIGINT) AS unexpected_rows,
              CAST(count(*) FILTER (WHERE o_orderkey % 11 <> 0 AND o_orderkey % 50 = 0) AS BIGINT) AS deleted_still_visible,
              CAST(count(*) FILTER (WHERE o_orderkey % 11 <> 0 AND o_orderkey % 25 <> 0 AND o_orderkey % 13 <> 0) AS BIGINT) AS all_fields_ok
       FROM orders""".replace(
        "count(*) FILTER (WHERE o_orderkey % 25 <> 0) AS", "count(*) FILTER (WHERE o_orderkey % 25 <> 0 AND o_orderkey % 11 <> 0) AS"
    ),
)
def cdc_verify(spark, sf):
    """A live table with known faults: deletes that were missed, rows nobody expects, wrong amounts."""
    log = change_log(spark, sf)
    missed = log.where((F.col("version") == 2) & (F.col("o_orderkey") % 50 == 0)).select("o_orderkey", "version")
    live = current.latest(matching.not_in(log, missed, ["o_orderkey", "version"]), ["o_orderkey"], "version", "deleted")
    wrong = live.withColumn("amount", F.when(F.col("o_orderkey") % 13 == 0, -1).otherwise(F.col("amount")))
    expected = current.latest(log, ["o_orderkey"], "version").where(F.col("o_orderkey") % 11 != 0)
    return current.verify_live(
        wrong.select("o_orderkey", "o_custkey", "amount"), expected, ["o_orderkey"], ["o_custkey", "amount"]
    )


@query(
    "cdc_lag",
    f"""WITH {LOG_SQL}, held AS (SELECT * FROM log WHERE {_LOADED}),
        held_newest AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)
        SELECT CAST(epoch((SELECT max(synced_at) FROM log)) - epoch((SELECT max(synced_at) FROM held)) AS BIGINT) AS behind_s,
               (SELECT count(*) FROM newest WHERE deleted = 0) - (SELECT count(*) FROM held_newest WHERE deleted = 0) AS rows_missing""",
)
def cdc_lag(spark, sf):
    log = change_log(spark, sf)
    return current.lag(log, _loaded(log), ["o_orderkey"], "version", "synced_at", "deleted")


@query(
    "cdc_update_from",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS VARCHAR) ELSE c_mktsegment END AS c_mktsegment,
              CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def cdc_update_from(spark, sf):
    """Staged rows replace two columns, one of them by NULL; staged keys that do not exist are ignored."""
    base = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    staged = base.where(F.col("c_custkey") % 3 == 0).select(
        "c_custkey", F.lit(None).cast("string").alias("c_mktsegment"), (F.col("c_acctbal") + 1).alias("c_acctbal")
    )
    strangers = staged.withColumn("c_custkey", -1 - F.col("c_custkey"))
    return current.update_from(base, staged.unionByName(strangers), ["c_custkey"], ["c_mktsegment", "c_acctbal"])


@query(
    "cdc_upsert",
    f"""WITH {LOG_SQL} SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN amount + 7 ELSE amount END AS amount,
          CAST(CASE WHEN o_orderkey % 4 = 0 THEN version + 1 ELSE version END AS BIGINT) AS version
        FROM newest UNION ALL SELECT -1 - o_orderkey, 7, 0 FROM newest WHERE o_orderkey % 40 = 0""",
)
def cdc_upsert(spark, sf):
    """New versions for every 4th order and some new keys, appended and read back as the latest rows."""
    log = change_log(spark, sf)
    newest = current.latest(log, ["o_orderkey"], "version")
    changes = newest.where(F.col("o_orderkey") % 4 == 0).withColumn("amount", F.col("amount") + 7)
    fresh = newest.where(F.col("o_orderkey") % 40 == 0).withColumn("o_orderkey", -1 - F.col("o_orderkey")).withColumn(
        "amount", F.lit(7).cast("bigint")
    )
    merged = current.upsert(log, changes.unionByName(fresh), ["o_orderkey"], "version")
    return current.latest(merged, ["o_orderkey"], "version").select("o_orderkey", "amount", "version")


@query(
    "cdc_failed_increment",
    f"""WITH {LOG_SQL} SELECT count(*) AS rows, CAST(sum(amount) AS BIGINT) AS amount, 1 AS failed_runs FROM log""",
)
def cdc_failed_increment(spark, sf):
    """A run that is lost after it wrote and before it published leaves the mark where it was; the run after it takes the
    same rows, and none is there twice."""
    root, log, failed = scratch(spark, "failed-run"), change_log(spark, sf), 0
    keys, early = ["o_orderkey", "version"], F.col("synced_at") < F.lit("2024-02-01").cast("timestamp_ntz")
    lake.publish(log.where(early), root)
    for lost in (True, False, False):
        target = lake.published(spark, root)
        fresh = current.increment(log, target, keys, "synced_at")
        try:
            if lost:
                fresh.write.parquet(f"{root}/data/version=lost")
                raise RuntimeError("lost between writing and publishing")
            lake.publish(target.unionByName(fresh), root)
        except RuntimeError:
            failed += 1
    return lake.published(spark, root).agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"), F.lit(failed).alias("failed_runs"))


@query(
    "cdc_run_log",
    f"""WITH {LOG_SQL} SELECT 'orders' AS job, CAST(2 AS BIGINT) AS runs, count(*) AS read_rows, count(*) AS written_rows, TRUE AS wrote_before_last FROM log""",
)
def cdc_run_log(spark, sf):
    """What the increments of a job read and wrote; the second of two runs finds nothing."""
    root, log = scratch(spark, "run-log"), change_log(spark, sf)
    for run in range(2):
        target = log.limit(0) if run == 0 else spark.read.schema(log.schema).parquet(f"{root}/data")
        fresh = current.increment(log, target, ["o_orderkey", "version"], "synced_at")
        fresh.write.mode("append").parquet(f"{root}/data/run={run}")
        written = spark.read.schema(log.schema).parquet(f"{root}/data/run={run}")
        record = current.run_record(written, "orders", F.count("*"), F.count("*"))
        record.write.mode("append").parquet(f"{root}/runs")
    report = current.run_report(spark.read.parquet(f"{root}/runs"))
    return report.select("job", "runs", "read_rows", "written_rows", (F.col("last_write") < F.col("last_run")).alias("wrote_before_last"))


@query(
    "cdc_update_from_repeats",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'second' ELSE c_mktsegment END AS c_mktsegment,
              CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 2 ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def cdc_update_from_repeats(spark, sf):
    """Three staged rows for each third customer: the newest one counts, and a customer stays one row."""
    base = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    third = base.where(F.col("c_custkey") % 3 == 0)
    stage = lambda n, name: third.select("c_custkey", F.lit(name).alias("c_mktsegment"), (F.col("c_acctbal") + n).alias("c_acctbal"), F.lit(n).alias("at"))
    staged = stage(0, None).unionByName(stage(2, "second")).unionByName(stage(1, "zero"))
    return current.update_from(base, staged, ["c_custkey"], ["c_mktsegment", "c_acctbal"], "at")


@query(
    "cdc_upsert_repeats",
    f"""WITH {LOG_SQL}, changes AS (
          SELECT o_orderkey, amount + x.n AS amount, x.n FROM newest, (VALUES (1), (2), (3)) x(n) WHERE o_orderkey % 4 = 0 AND x.n <= 1 + o_orderkey % 3)
        SELECT o_orderkey, CAST(version AS BIGINT) AS version, amount FROM log UNION ALL
        SELECT c.o_orderkey, CAST(n.version + row_number() OVER (PARTITION BY c.o_orderkey ORDER BY c.n) AS BIGINT), c.amount
        FROM changes c JOIN newest n USING (o_orderkey)""",
)
def cdc_upsert_repeats(spark, sf):
    """One to three changes of every 4th order in one load: each gets a version of its own, in their order."""
    log = change_log(spark, sf)
    newest = current.latest(log, ["o_orderkey"], "version").where(F.col("o_orderkey") % 4 == 0)
    several = newest.withColumn("n", F.explode(F.sequence(F.lit(1), (1 + F.col("o_orderkey") % 3).cast("int"))))
    changes = several.withColumn("amount", F.col("amount") + F.col("n"))
    return current.upsert(log, changes, ["o_orderkey"], "version", ["n"]).select("o_orderkey", "version", "amount")


@query(
    "cdc_commits",
    f"""WITH {LOG_SQL}, mark AS (SELECT max(synced_at) AS mark_at FROM log WHERE {_LOADED})
        SELECT CAST(version AS BIGINT) AS version, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, max(synced_at) AS newest
        FROM log, mark WHERE ({_LOADED}) OR synced_at >= mark_at - INTERVAL 1 MINUTE GROUP BY version""",
)
def cdc_commits(spark, sf):
    """Two increments by the statistics of commits: the mark is read from them, and only files that may hold a row on
    offer are opened. The second increment adds nothing."""
    source, root, keys = scratch(spark, "commits-source"), scratch(spark, "commits"), ["o_orderkey", "version"]
    change_log(spark, sf).write.parquet(source)
    log = spark.read.parquet(source)
    commits.create(spark, root)
    for month in ("2024-01", "2024-02"):
        part = _loaded(log).where(F.date_format("synced_at", "yyyy-MM") == month)
        commits.commit(part.repartitionByRange("synced_at"), root, keys, "synced_at", f"load-{month}")
    for run in range(2):
        commits.commit(commits.increment(log, root, keys, "synced_at"), root, keys, "synced_at", f"run-{run}")
    return commits.read(spark, root, log.schema).groupBy("version").agg(
        F.count("*").alias("rows"), F.count_distinct("o_orderkey").alias("keys"), F.max("synced_at").alias("newest")
    )
