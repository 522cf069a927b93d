"""The cost ledger built from line items, and the allocation of a day bill by the events as a statement log.

Amounts are whole numbers (cents, pieces), so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import ledger as L
from tidewell.operators.scan import numbered
from tidewell.operators.totals import with_grand_total
from tidewell.plans.allocation import allocate
from tidewell.sources import keyed
from tidewell.suite.base import cents, query, table
from tidewell.workspace import scratch, stored

SPEC = L.LedgerSpec()
_FETCHED = "2024-01-01 00:00:00"


def _service_days(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier and ship day the amounts of a service record."""
    lines = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    days = lines.groupBy("l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")).agg(
        F.sum(cents(F.col("l_extendedprice"))).alias("compute"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("transfer"),
        F.sum(cents(F.col("l_tax"))).alias("tier1"),
        F.sum(cents(F.col("l_discount"))).alias("tier2"),
    )
    return days.join(s, "l_suppkey")


def ledger_records(spark: SparkSession, sf: str, faults: bool) -> DataFrame:
    """Raw records (window, record): services per supplier and day, warehouses per nation and day.

    With ``faults`` some services carry an unknown type, a metric of another type, a quoted number, or no id.
    """
    s = _service_days(spark, sf)
    supp = F.col("l_suppkey")
    broken = F.lit(faults)
    kind = F.when(broken & (supp % 50 == 7), "mystery").otherwise("service")
    entity = F.when(broken & (supp % 50 == 9), F.lit("null")).otherwise(F.concat(F.lit('"s'), supp.cast("string"), F.lit('"')))
    first_metric = F.when(broken & (supp % 50 == 11), "storage").otherwise("compute")
    amount = F.when(broken & (supp % 50 == 13), F.concat(F.lit('"'), F.col("compute").cast("string"), F.lit('"'))).otherwise(
        F.col("compute").cast("string")
    )
    metrics = F.concat(
        F.lit('"'), first_metric, F.lit('":'), amount,
        F.lit(',"publicDataTransfer":'), F.col("transfer").cast("string"),
        F.lit(',"interRegionTier1DataTransfer":'), F.col("tier1").cast("string"),
        F.lit(',"interRegionTier2DataTransfer":'), F.col("tier2").cast("string"),
    )
    total = F.col("compute") + F.col("transfer") + F.col("tier1") + F.col("tier2")
    window = F.substring("day", 1, 7).alias("window")
    services = s.select(
        window,
        F.concat(
            F.lit('{"date":"'), F.col("day"), F.lit('","dataWarehouseId":"w'), F.col("nation").cast("string"),
            F.lit('","serviceId":"s'), supp.cast("string"), F.lit('","entityType":"'), kind, F.lit('","entityId":'), entity,
            F.lit(',"entityName":"service '), (supp % 10).cast("string"), F.lit('","organizationTier":"tier-a","locked":'),
            F.when(F.col("day") < "2001-06-01", "true").otherwise("false"), F.lit(',"metrics":{'), metrics,
            F.lit('},"total":'), total.cast("string"), F.lit("}"),
        ).alias("record"),
    )
    w = s.groupBy("nation", "day").agg(F.sum("transfer").alias("storage"), F.count("*").alias("backup"))
    nation = F.col("nation").cast("string")
    warehouses = w.select(
        window,
        F.concat(
            F.lit('{"date":"'), F.col("day"), F.lit('","dataWarehouseId":"w'), nation, F.lit('","serviceId":null,"entityType":"warehouse"'),
            F.lit(',"entityId":"w'), nation, F.lit('","entityName":"warehouse '), nation, F.lit('","organizationTier":"","locked":'),
            F.when(F.col("day") < "2001-06-01", "true").otherwise("false"), F.lit(',"metrics":{"storage":'), F.col("storage").cast("string"),
            F.lit(',"backup":'), F.col("backup").cast("string"), F.lit('},"total":'),
            (F.col("storage") + F.col("backup")).cast("string"), F.lit("}"),
        ).alias("record"),
    )
    return services.unionByName(warehouses)


def ledger_headers(spark: SparkSession, sf: str, faults: bool) -> DataFrame:
    """Per month the grand total of its response; with ``faults`` the Januaries are one too high."""
    s = _service_days(spark, sf)
    window = F.substring("day", 1, 7).alias("window")
    service_total = s.select(window, (F.col("compute") + F.col("transfer") * 2 + F.col("tier1") + F.col("tier2")).alias("t"))
    backups = s.select(window, "nation", "day").groupBy("window", "nation", "day").agg(F.count("*").alias("t"))
    sums = service_total.unionByName(backups.select("window", "t")).groupBy("window").agg(F.sum("t").alias("t"))
    off = F.when(F.lit(faults) & F.col("window").endswith("-01"), 1).otherwise(0)
    return sums.select(
        "window", F.lit(200).alias("status"), (F.col("t") + off).cast("double").alias("grand_total"), F.lit(0).alias("records")
    )


def flat_ledger(spark: SparkSession, sf: str, faults: bool = False, readers: int = 1) -> DataFrame:
    """The validated rows. They are stored where several steps read them; for one reader only the columns it needs are
    made, and nothing is written."""
    flat = L.flatten(ledger_records(spark, sf, faults), SPEC, F.lit(_FETCHED).cast("timestamp"))
    return stored(flat, "ledger-rows") if readers > 1 else flat


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows typed, as the published table holds them; the reports start from here."""
    s = _service_days(spark, sf).withColumn("date", F.to_date("day"))
    names = {"compute": "compute", "publicDataTransfer": "transfer", "interRegionTier1DataTransfer": "tier1", "interRegionTier2DataTransfer": "tier2"}
    w = s.groupBy("nation", "date").agg(F.sum("transfer").alias("storage"), F.count("*").alias("backup"))
    nation, supp = F.col("nation").cast("string"), F.col("l_suppkey").cast("string")

    def rows(df, kind, entity, name, service, tier, values):
        total = sum((F.col(c) for c in values.values()), F.lit(0))
        return df.select(
            "date",
            F.lit(kind).alias("entity_type"),
            entity.alias("entity_id"),
            name.alias("entity_name"),
            service.alias("service_id"),
            F.concat(F.lit("w"), nation).alias("warehouse_id"),
            F.lit(tier).alias("tier"),
            (F.col("date") < F.lit("2001-06-01").cast("date")).alias("locked"),
            total.cast("double").alias("total"),
            *[(F.col(values[m]) if m in values else F.lit(0)).cast("double").alias(m) for m in SPEC.metric_names],
            F.lit(_FETCHED).cast("timestamp").alias("fetched_at"),
        )

    sid = F.concat(F.lit("s"), supp)
    label = F.concat(F.lit("service "), (F.col("l_suppkey") % 10).cast("string"))
    wid = F.concat(F.lit("w"), nation)
    return rows(s, "service", sid, label, sid, "tier-a", names).unionByName(
        rows(w, "warehouse", wid, F.concat(F.lit("warehouse "), nation), F.lit(""), "", {"storage": "storage", "backup": "backup"})
    )


LEDGER_SQL = """sd AS (
  SELECT l_suppkey AS supp, s_nationkey AS nation, CAST(l_shipdate AS DATE) AS day,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS compute, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS transfer,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tier1, CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS tier2
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
wd AS (SELECT nation, day, CAST(sum(transfer) AS BIGINT) AS storage, count(*) AS backup FROM sd GROUP BY ALL),
led AS (
  SELECT day, 'service' AS entity_type, 's' || supp AS entity_id, 'service ' || (supp % 10) AS entity_name, day < DATE '2001-06-01' AS locked,
         CAST(compute + transfer + tier1 + tier2 AS DOUBLE) AS total, 0.0::DOUBLE AS storage, 0.0::DOUBLE AS backup, CAST(compute AS DOUBLE) AS compute,
         CAST(transfer AS DOUBLE) AS transfer, CAST(tier1 AS DOUBLE) AS tier1, CAST(tier2 AS DOUBLE) AS tier2, supp FROM sd
  UNION ALL
  SELECT day, 'warehouse', 'w' || nation, 'warehouse ' || nation, day < DATE '2001-06-01', CAST(storage + backup AS DOUBLE),
         CAST(storage AS DOUBLE), CAST(backup AS DOUBLE), 0, 0, 0, 0, NULL FROM wd)"""


@query(
    "ledger_flatten",
    f"WITH {LEDGER_SQL} SELECT day AS date, entity_type, entity_id, entity_name, locked, total, storage, backup, compute, transfer FROM led",
)
def ledger_flatten(spark, sf):
    return flat_ledger(spark, sf).select(
        "date", "entity_type", "entity_id", "entity_name", "locked", "total", "storage", "backup", "compute",
        F.col("publicDataTransfer").alias("transfer"),
    )


@query(
    "ledger_checks",
    f"""WITH {LEDGER_SQL}, f AS (
          SELECT 'unknown entityType' AS kind, count(*) AS n FROM sd WHERE supp % 50 = 7 UNION ALL
          SELECT 'record without entityId', count(*) FROM sd WHERE supp % 50 = 9 UNION ALL
          SELECT 'unexpected metric', count(*) FROM sd WHERE supp % 50 = 11 UNION ALL
          SELECT 'bad metric value', count(*) FROM sd WHERE supp % 50 = 13 UNION ALL
          SELECT 'totals differ', count(*) FROM (SELECT strftime(day, '%Y-%m') AS w, bool_or(supp % 50 = 9) AS lost FROM sd GROUP BY 1)
          WHERE lost OR w LIKE '%-01')
        SELECT kind, n FROM f WHERE n > 0""",
)
def ledger_checks(spark, sf):
    """Every fault put into the records and headers is named; months that lost a record or carry a wrong total differ."""
    flat = flat_ledger(spark, sf, faults=True, readers=2)
    failures = L.all_failures(flat, ledger_headers(spark, sf, faults=True))
    names = {"entity_type": "unknown entityType", "metric_name": "unexpected metric", "metric_value": "bad metric value", "grand_total": "totals differ"}
    kind = F.when((F.col("rule") == "missing_field") & (F.col("field") == "entityId"), "record without entityId")
    for rule, name in names.items():
        kind = kind.when(F.col("rule") == rule, name)
    return failures.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query(
    "ledger_control_totals",
    f"""WITH {LEDGER_SQL} SELECT strftime(day, '%Y-%m') AS "window", sum(total) AS grand_total, sum(total) AS sum_total,
          count(*) AS records, TRUE AS agrees FROM led GROUP BY 1""",
)
def ledger_control_totals(spark, sf):
    return L.control_totals(flat_ledger(spark, sf), ledger_headers(spark, sf, faults=False))


@query(
    "ledger_notes",
    f"""WITH {LEDGER_SQL} SELECT 0 AS sum_differs, 0 AS service_id_rule, count(*) FILTER (WHERE NOT locked) AS provisional_records,
          count(*) AS records, 0 AS duplicate_keys FROM led""",
)
def ledger_notes(spark, sf):
    return L.notes(flat_ledger(spark, sf, readers=2), SPEC)


@query(
    "ledger_tiers",
    f"""WITH {LEDGER_SQL} SELECT CASE entity_type WHEN 'service' THEN 'tier-a' ELSE '(absent)' END AS tier, count(*) AS records FROM led GROUP BY 1""",
)
def ledger_tiers(spark, sf):
    return L.tiers(flat_ledger(spark, sf))


@query(
    "ledger_duplicates",
    f"""WITH {LEDGER_SQL} SELECT day AS date, entity_type, entity_id, CAST(2 AS BIGINT) AS rows FROM led WHERE entity_type = 'warehouse'""",
)
def ledger_duplicates(spark, sf):
    """The warehouse records fetched twice."""
    flat = ledger(spark, sf)
    return L.duplicate_keys(flat.unionByName(flat.where("entity_type = 'warehouse'")))


@query(
    "ledger_current",
    f"""WITH {LEDGER_SQL} SELECT entity_type, count(*) AS records, sum(CASE WHEN locked THEN total ELSE total + 1 END) AS total FROM led GROUP BY 1""",
)
def ledger_current(spark, sf):
    """Provisional days fetched again later with a higher total: the later row replaces the earlier one."""
    first = ledger(spark, sf)
    again = first.where(~F.col("locked")).withColumn("total", F.col("total") + 1).withColumn(
        "fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY")
    )
    newest = L.current(again.unionByName(first))
    return newest.groupBy("entity_type").agg(F.count("*").alias("records"), F.sum("total").alias("total"))


_METRIC_ROWS = [
    ("warehouse", "storage", "storage"),
    ("warehouse", "backup", "backup"),
    ("service", "compute", "compute"),
    ("service", "publicDataTransfer", "transfer"),
    ("service", "interRegionTier1DataTransfer", "tier1"),
    ("service", "interRegionTier2DataTransfer", "tier2"),
    ("service", "interRegionTier3DataTransfer", None),
    ("service", "interRegionTier4DataTransfer", None),
    ("pipe", "compute", None),
    ("pipe", "dataTransfer", None),
    ("pipe", "initialLoad", None),
]


@query(
    "ledger_totals",
    f"WITH {LEDGER_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS entity_type, '{m}' AS metric, "
        + (f"sum({c}) AS amount FROM led WHERE entity_type = '{t}'" if c else "0.0::DOUBLE AS amount")
        for t, m, c in _METRIC_ROWS
    ),
)
def ledger_totals(spark, sf):
    return L.totals_by_metric(ledger(spark, sf), SPEC)


@query(
    "ledger_entities",
    f"""WITH {LEDGER_SQL} SELECT entity_type, entity_id, any_value(entity_name) AS entity_name, sum(total) AS total,
          count(DISTINCT day) AS days FROM led GROUP BY 1, 2""",
)
def ledger_entities(spark, sf):
    return L.totals_by_entity(ledger(spark, sf))


@query(
    "ledger_provisional",
    f"WITH {LEDGER_SQL} SELECT day AS date, count(*) AS records, sum(total) AS total FROM led WHERE NOT locked GROUP BY 1",
)
def ledger_provisional(spark, sf):
    return L.provisional_days(ledger(spark, sf))


@query(
    "ledger_storage_backup",
    f"WITH {LEDGER_SQL} SELECT entity_type, count(*) AS records, sum(storage) AS storage, sum(backup) AS backup FROM led GROUP BY 1",
)
def ledger_storage_backup(spark, sf):
    return L.storage_and_backup(ledger(spark, sf))


@query(
    "ledger_warehouse_share",
    f"""WITH {LEDGER_SQL} SELECT entity_name, entity_id, min(day) AS first_day, max(day) AS last_day, sum(storage) AS storage, sum(backup) AS backup,
          round(100 * sum(backup) / nullif(sum(storage) + sum(backup), 0), 1) AS backup_pct FROM led WHERE entity_type = 'warehouse' GROUP BY 1, 2""",
)
def ledger_warehouse_share(spark, sf):
    return L.warehouse_backup_share(ledger(spark, sf), SPEC)


@query(
    "ledger_service_days",
    f"""WITH {LEDGER_SQL} SELECT entity_name AS service, day AS date, compute, transfer, total,
          CASE WHEN locked THEN '' ELSE 'provisional' END AS note FROM led WHERE entity_type = 'service'""",
)
def ledger_service_days(spark, sf):
    return L.service_days(ledger(spark, sf), SPEC).select(
        "service", "date", "compute", F.col("publicDataTransfer").alias("transfer"), "total", "note"
    )


_CATEGORY_SQL = """cat AS (
  SELECT entity_name AS service, unnest(['compute','public transfer','inter-region tier 1','inter-region tier 2','inter-region tier 3','inter-region tier 4']) AS category,
         unnest([compute, transfer, tier1, tier2, 0.0, 0.0]) AS v FROM led WHERE entity_type = 'service')"""


@query(
    "ledger_shares",
    f"""WITH {LEDGER_SQL}, {_CATEGORY_SQL}, s AS (SELECT service, category, sum(v) AS amount FROM cat GROUP BY 1, 2)
        SELECT service, category, amount, round(100 * (amount / nullif(sum(amount) OVER (PARTITION BY service), 0)), 2) AS share_pct FROM s""",
)
def ledger_shares(spark, sf):
    return L.category_shares(ledger(spark, sf), SPEC)


@query(
    "ledger_shares_all",
    f"""WITH {LEDGER_SQL}, {_CATEGORY_SQL}, s AS (SELECT category, sum(v) AS amount FROM cat GROUP BY 1)
        SELECT category, amount, round(100 * (amount / nullif(sum(amount) OVER (), 0)), 2) AS share_pct FROM s""",
)
def ledger_shares_all(spark, sf):
    return L.category_shares(ledger(spark, sf), SPEC, per_service=False)


@query(
    "ledger_windows",
    """WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
            s AS (SELECT unnest(range(0, CAST(date_diff('day', a, b) AS BIGINT) + 1, 31)) AS n, a, b FROM r)
       SELECT a + CAST(n AS INTEGER) AS first_day, least(a + CAST(n AS INTEGER) + 30, b) AS last_day FROM s""",
)
def ledger_windows(spark, sf):
    days = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")
    )
    w = days.select(F.explode(L.windows(F.col("a"), F.col("b"))).alias("w"))
    return w.select(F.col("w.from").alias("first_day"), F.col("w.to").alias("last_day"))


@query(
    "ledger_backups",
    """WITH b AS (SELECT 's' || (o_custkey % 20) AS service_id, CASE o_orderstatus WHEN 'O' THEN 'in_progress' WHEN 'P' THEN 'error' ELSE 'done' END AS status,
                CASE WHEN o_orderkey % 4 = 0 THEN 'full' ELSE 'incremental' END AS type,
                CASE WHEN o_orderkey % 9 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS size_bytes, o_orderdate AS started_at FROM orders)
       SELECT service_id, count(*) AS backups, count(*) FILTER (WHERE type = 'full') AS "full", count(*) FILTER (WHERE type = 'incremental') AS incremental,
              count(*) FILTER (WHERE status = 'done') AS done, CAST(coalesce(sum(size_bytes) FILTER (WHERE status = 'done'), 0) AS BIGINT) AS done_bytes,
              count(*) FILTER (WHERE status = 'done' AND size_bytes IS NULL) AS done_without_size, min(started_at) AS oldest, max(started_at) AS newest
       FROM b GROUP BY 1""",
)
def ledger_backups(spark, sf):
    o = table(spark, sf, "orders").select(
        F.concat(F.lit("s"), (F.col("o_custkey") % 20).cast("string")).alias("service_id"),
        F.when(F.col("o_orderstatus") == "O", "in_progress").when(F.col("o_orderstatus") == "P", "error").otherwise("done").alias("status"),
        F.when(F.col("o_orderkey") % 4 == 0, "full").otherwise("incremental").alias("type"),
        F.when(F.col("o_orderkey") % 9 != 0, cents(F.col("o_totalprice"))).alias("size_bytes"),
        F.col("o_orderdate").alias("started_at"),
    )
    return L.backup_summary(o)


@query(
    "ledger_warehouse_bill",
    """WITH sd AS (SELECT DISTINCT l_suppkey AS supp, s_nationkey AS nation, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
            b AS (SELECT nation, sum(n) AS backup, count(*) AS days FROM (SELECT nation, day, count(*) AS n FROM sd GROUP BY ALL) GROUP BY nation),
            s AS (SELECT DISTINCT supp, nation FROM sd)
       SELECT 's' || supp AS service, 'w' || s.nation AS warehouse, CAST(backup AS DOUBLE) AS backup, days,
              count(*) OVER (PARTITION BY s.nation) - 1 AS shared_with, backup / days AS backup_per_day FROM s JOIN b ON b.nation = s.nation""",
)
def ledger_warehouse_bill(spark, sf):
    ordered = ledger(spark, sf).withColumn("line", F.xxhash64("entity_id", "date"))
    return L.warehouse_backup_bill(ordered, SPEC, ["line"]).drop("name")


@query(
    "ledger_run_cost",
    """SELECT o_orderpriority AS step, max(CAST(o_orderkey % 600 AS DOUBLE)) AS seconds,
              round(sum(4 * (o_orderkey % 600) / 3600.0 * CASE o_orderkey % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 ELSE 2.0 END), 4) AS cost
       FROM orders GROUP BY 1""",
)
def ledger_run_cost(spark, sf):
    """Instance seconds per step times the price of the item, prices given as data."""
    usage = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("step"),
        F.concat(F.lit("item"), (F.col("o_orderkey") % 3).cast("string")).alias("item"),
        F.lit(4).alias("count"),
        (F.col("o_orderkey") % 600).cast("double").alias("seconds"),
    )
    prices = spark.createDataFrame([("item0", 0.5), ("item1", 0.25), ("item2", 2.0)], "item string, price_per_hour double")
    return L.run_cost(usage, prices)


# --- allocation ------------------------------------------------------------------------------------------------


def _bill(spark: SparkSession, sf: str) -> DataFrame:
    """Bills of five services and their warehouses for 30 days, from the orders. Services 3 and 4 share a warehouse, and
    warehouse 4 belongs to nobody."""
    o = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 5).alias("s"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int")).alias("date"),
        cents(F.col("o_totalprice")).alias("c"),
    )
    zero = {m: F.lit(0.0) for m in SPEC.metric_names}

    def rows(kind: str, prefix: str, metric: str, value: Column) -> DataFrame:
        name = F.concat(F.lit(prefix), F.col("s").cast("string"))
        grouped = o.groupBy("s", "date").agg(value.cast("double").alias("v"))
        values = {**zero, metric: F.col("v")}
        return grouped.select(
            "date",
            F.lit(kind).alias("entity_type"),
            name.alias("entity_id"),
            name.alias("entity_name"),
            (name if kind == "service" else F.lit("")).alias("service_id"),
            # Odd warehouses carry their id only as the entity, as some responses do.
            (
                F.concat(F.lit("w"), F.least(F.col("s"), F.lit(3)).cast("string"))
                if kind == "service"
                else F.when(F.col("s") % 2 == 0, name).otherwise("")
            ).alias("warehouse_id"),
            F.lit("").alias("tier"),
            (F.dayofmonth("date") < 29).alias("locked"),
            F.col("v").alias("total"),
            *[v.alias(m) for m, v in values.items()],
            F.lit(_FETCHED).cast("timestamp").alias("fetched_at"),
        )

    return rows("service", "s", "compute", F.sum("c")).unionByName(rows("warehouse", "w", "storage", F.count("*")))


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.lit("s"), (F.col("p_partkey") % 5).cast("string")).alias("service"),
        F.col("p_brand").alias("database"),
        F.col("p_type").alias("table"),
        (F.col("p_size") * 1000).cast("bigint").alias("bytes_on_disk"),
        (F.col("p_partkey") % 10 != 0).alias("active"),
    )


def _statements(spark: SparkSession, sf: str) -> DataFrame:
    micros = (F.col("value") * 100).cast("decimal(20,0)").cast("bigint") * 10_000_000
    return table(spark, sf, "events").select(
        F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("service"),
        F.when(F.col("event_type") == "signup", "QueryStart")
        .when(F.col("event_type") == "error", "ExceptionWhileProcessing")
        .otherwise("QueryFinish")
        .alias("type"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("user"),
        F.create_map(
            F.lit("UserTimeMicroseconds"), micros, F.lit("SystemTimeMicroseconds"), F.lit(1_000_000).cast("bigint")
        ).alias("counters"),
    )


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    """Core samples at the times of the events, two hosts per service; day 20 of service s0 has none."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("service"),
        F.concat(F.lit("host-"), (F.col("event_id") % 2).cast("string")).alias("hostname"),
        F.col("ts").alias("event_time"),
        F.when((F.dayofmonth("ts") == 20) & (F.col("user_id") % 5 == 0), "Uptime").otherwise("CGroupMaxCPU").alias("metric"),
        F.lit(4.0).alias("value"),
    )


def _allocation(spark: SparkSession, sf: str, check: bool = False):
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date")
    return allocate(
        _bill(spark, sf), _parts(spark, sf), _statements(spark, sf), _samples(spark, sf), first, last, SPEC, check=check
    )


ALLOC_SQL = """raw AS (
  SELECT o_custkey % 5 AS s, DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS day,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS c, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY ALL),
size AS (SELECT p_partkey % 5 AS s, CAST(sum(p_size * 1000) AS BIGINT) AS bytes FROM part WHERE p_partkey % 10 <> 0 GROUP BY ALL),
bill AS (
  SELECT 's' || r.s AS service, r.day, r.c AS compute_billed,
         coalesce(w.n, 0) * (bytes / sum(bytes) OVER (PARTITION BY least(r.s, 3), r.day)) AS storage_billed,
         CASE WHEN day(r.day) < 29 THEN '' ELSE 'provisional' END AS provisional
  FROM raw r JOIN size ON size.s = r.s LEFT JOIN raw w ON w.s = least(r.s, 3) AND w.day = r.day),
db AS (SELECT 's' || (p_partkey % 5) AS service, p_brand AS database, CAST(sum(p_size * 1000) AS BIGINT) AS bytes FROM part WHERE p_partkey % 10 <> 0 GROUP BY ALL),
shares AS (SELECT service, database, bytes, bytes / sum(bytes) OVER (PARTITION BY service) AS share FROM db),
stor AS (SELECT service, day, database, bytes, share, share * storage_billed AS allocated FROM bill JOIN shares USING (service)),
cpu AS (SELECT 's' || (user_id % 5) AS service, CAST(ts AS DATE) AS day, 'u' || (user_id % 20) AS "user",
               CAST(sum(CAST(round(value * 100) AS BIGINT) * 10000000 + 1000000) AS DOUBLE) / 1e6 AS cpu_s
        FROM events WHERE event_type <> 'signup' AND ts < TIMESTAMP '2024-01-31' GROUP BY ALL),
sec AS (SELECT 's' || (user_id % 5) AS service, 'host-' || (event_id % 2) AS host, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS s,
               count(*) AS n, 4.0 * count(*) AS v FROM events
        WHERE ts < TIMESTAMP '2024-01-31' AND NOT (day(ts) = 20 AND user_id % 5 = 0) GROUP BY ALL),
gap AS (SELECT *, date_diff('second', lag(s) OVER (PARTITION BY service, host, day ORDER BY s), s) AS g FROM sec),
hostday AS (SELECT service, host, day, CAST(sum(n) AS BIGINT) AS samples,
                   sum(v) * coalesce(quantile_disc(g, 0.5) FILTER (WHERE g > 0), 0) AS core_seconds FROM gap GROUP BY ALL),
cap AS (SELECT service, day, count(*) AS replicas, CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(core_seconds) AS DOUBLE) AS capacity_s FROM hostday GROUP BY ALL),
rate AS (SELECT b.*, coalesce(replicas, 0) AS replicas, coalesce(capacity_s, 0) AS capacity_s, coalesce(c.cpu_s, 0) AS cpu_s
         FROM bill b LEFT JOIN (SELECT service, day, sum(cpu_s) AS cpu_s FROM cpu GROUP BY ALL) c USING (service, day) LEFT JOIN cap USING (service, day)),
days AS (SELECT *, CASE WHEN compute_billed > 0 AND capacity_s <= 0 THEN 'no system log'
                        WHEN cpu_s > capacity_s THEN 'cpu above capacity: shares scaled down' ELSE '' END AS flag,
                CASE WHEN capacity_s > 0 THEN compute_billed / greatest(capacity_s, cpu_s) ELSE 0 END AS per_cpu_s,
                CASE WHEN capacity_s > 0 THEN compute_billed * (1 - least(1, cpu_s / capacity_s)) ELSE compute_billed END AS unallocated FROM rate),
comp AS (SELECT service, day, "user", cpu.cpu_s, cpu.cpu_s * per_cpu_s AS allocated FROM cpu JOIN days USING (service, day))"""


@query(
    "ledger_alloc_storage",
    f"WITH {ALLOC_SQL} SELECT service, day, database, bytes, round(allocated, 6) AS allocated FROM stor",
)
def ledger_alloc_storage(spark, sf):
    return _allocation(spark, sf).storage.withColumn("allocated", F.round("allocated", 6))


@query(
    "ledger_alloc_usage",
    f"""WITH {ALLOC_SQL} SELECT service, day, "user", round(cpu_s, 3) AS cpu_s, round(allocated, 4) AS allocated FROM comp""",
)
def ledger_alloc_usage(spark, sf):
    used = _allocation(spark, sf).compute
    return used.withColumn("cpu_s", F.round("cpu_s", 3)).withColumn("allocated", F.round("allocated", 4))


@query("ledger_capacity", f"WITH {ALLOC_SQL} SELECT service, day, replicas, samples, capacity_s FROM cap")
def ledger_capacity(spark, sf):
    return _allocation(spark, sf).capacity


@query(
    "ledger_balance",
    f"""WITH {ALLOC_SQL} SELECT d.service, d.day, compute_billed, round(coalesce(c.a, 0), 4) AS compute_allocated, round(unallocated, 4) AS compute_unallocated,
          storage_billed, round(coalesce(s.a, 0), 6) AS storage_allocated, d.replicas, capacity_s, round(d.cpu_s, 3) AS cpu_s, provisional, flag, TRUE AS balanced
        FROM days d LEFT JOIN (SELECT service, day, sum(allocated) AS a FROM comp GROUP BY ALL) c USING (service, day)
             LEFT JOIN (SELECT service, day, sum(allocated) AS a FROM stor GROUP BY ALL) s USING (service, day)""",
)
def ledger_balance(spark, sf):
    b = _allocation(spark, sf, check=True).balance
    # The amounts run into millions of cents, so the tolerance is relative to them here.
    balanced = (F.abs("compute_diff") <= 1e-9 * F.greatest(F.col("compute_billed"), F.lit(1.0))) & (F.abs("storage_diff") <= 1e-6)
    return b.select(
        "service", "day", "compute_billed", F.round("compute_allocated", 4).alias("compute_allocated"),
        F.round("compute_unallocated", 4).alias("compute_unallocated"), "storage_billed",
        F.round("storage_allocated", 6).alias("storage_allocated"), "replicas", "capacity_s", F.round("cpu_s", 3).alias("cpu_s"),
        "provisional", "flag", balanced.alias("balanced"),
    )


@query(
    "ledger_compute_report",
    f"""WITH {ALLOC_SQL}, t AS (SELECT sum(compute_billed) AS t, sum(unallocated) AS u, count(*) FILTER (WHERE flag = 'no system log') AS silent FROM days)
        SELECT 0 AS position, "user" AS who, round(sum(cpu_s), 1) AS cpu_seconds, round(sum(allocated), 2) AS amount,
               round(100 * (sum(allocated) / any_value(t.t)), 2) AS share_pct, '' AS note FROM comp, t GROUP BY "user"
        UNION ALL SELECT 1, 'unallocated', 0, round(u, 2), round(100 * (u / t), 2),
               CASE WHEN silent > 0 THEN 'includes ' || silent || ' day(s) flagged no system log' ELSE '' END FROM t
        UNION ALL SELECT 2, 'total billed', 0, round(t, 2), 100, '' FROM t""",
)
def ledger_compute_report(spark, sf):
    return _allocation(spark, sf).compute_report().withColumn("amount", F.round("amount", 2))


@query(
    "ledger_storage_report",
    f"""WITH {ALLOC_SQL}, whole AS (SELECT service, sum(bytes) AS t FROM db GROUP BY 1), paid AS (SELECT service, sum(storage_billed) AS b FROM bill GROUP BY 1)
        SELECT service, CAST(0 AS TINYINT) AS is_total, database, bytes AS bytes_on_disk, round(100 * (bytes / t), 2) AS share_pct,
               round(bytes / t * b, 4) AS allocated_storage FROM db JOIN whole USING (service) JOIN paid USING (service)
        UNION ALL SELECT service, 1, 'total', CAST(t AS BIGINT), 100, round(b, 4) FROM whole JOIN paid USING (service)""",
)
def ledger_storage_report(spark, sf):
    report = _allocation(spark, sf).storage_report().drop("active_size")
    return report.withColumn("allocated_storage", F.round("allocated_storage", 4))


@query(
    "ledger_largest_tables",
    f"""WITH {ALLOC_SQL}, p AS (SELECT 's' || (p_partkey % 5) AS service, p_brand AS database, p_type AS "table", CAST(sum(p_size * 1000) AS BIGINT) AS bytes
          FROM part WHERE p_partkey % 10 <> 0 GROUP BY ALL),
          t AS (SELECT service, sum(bytes) AS t FROM p GROUP BY 1), b AS (SELECT service, sum(storage_billed) AS b FROM bill GROUP BY 1)
        SELECT service, database, "table", bytes, round(100 * (bytes / t), 2) AS share_pct, round(bytes / t * b, 4) AS allocated_storage
        FROM p JOIN t USING (service) JOIN b USING (service) ORDER BY bytes DESC, service, database, "table" LIMIT 50""",
)
def ledger_largest_tables(spark, sf):
    found = L.largest_tables(_parts(spark, sf), _allocation(spark, sf).billed)
    return found.withColumn("allocated_storage", F.round("allocated_storage", 4))


@query(
    "ledger_reconciled",
    f"""WITH {ALLOC_SQL} SELECT service, database, round(sum(allocated), 4) AS by_allocation, TRUE AS agrees FROM stor GROUP BY ALL""",
)
def ledger_reconciled(spark, sf):
    """The tables of each database add up to what the allocation gave it."""
    a = _allocation(spark, sf)
    found = L.reconciled(_parts(spark, sf), a.billed, a.storage)
    return found.select("service", "database", F.round("by_allocation", 4).alias("by_allocation"), "agrees")


@query(
    "ledger_rollup_total",
    """SELECT CAST(0 AS TINYINT) AS is_total, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS priority, count(*) AS orders,
              CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM orders GROUP BY 2
       UNION ALL SELECT 1, 'total', count(*), CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) FROM orders""",
)
def ledger_rollup_total(spark, sf):
    """A blank label is an ordinary row; the total is told apart by grouping()."""
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("").alias("priority"),
        cents(F.col("o_totalprice")).alias("c"),
    )
    return with_grand_total(o, "priority", "total", {"orders": F.count("*"), "amount": F.sum("c")})


@query(
    "ledger_append",
    f"""WITH {LEDGER_SQL} SELECT day AS date, entity_id, CASE WHEN day >= DATE '1995-01-01' THEN total + 1 ELSE total END AS total,
          day >= DATE '1995-01-01' AS corrected FROM led""",
)
def ledger_append(spark, sf):
    """JSON lines in two batches that overlap, the second with corrected totals; the first is loaded again at the end."""
    root = scratch(spark, "ledger-append")
    rows = ledger(spark, sf).select("date", "entity_id", "total")
    late = F.col("date") >= F.lit("1995-01-01").cast("date")
    first = rows.where(F.col("date") < F.lit("1996-01-01").cast("date")).withColumn("fetched", F.lit(1)).withColumn("corrected", F.lit(False))
    second = rows.where(late).withColumn("fetched", F.lit(2)).withColumn("corrected", F.lit(True)).withColumn("total", F.col("total") + 1)
    schema = T.StructType.fromDDL("date date, entity_id string, total double, fetched int, corrected boolean")
    for name, part in (("a", first), ("b", second)):
        part.select(F.to_json(F.struct(*part.columns)).alias("value")).write.text(f"{root}/in/{name}")
    for batch in ("a", "b", "a"):
        keyed.load_lines(spark, [f"{root}/in/{batch}"], schema, f"{root}/table", ["date", "entity_id"], batch)
    return keyed.newest(spark, f"{root}/table", schema, ["date", "entity_id"], ["fetched"]).drop("fetched")


@query(
    "ledger_report_order",
    f"""WITH {ALLOC_SQL}, r AS (
          SELECT service, 0 AS is_total, database, bytes FROM db UNION ALL SELECT service, 1, 'total', CAST(sum(bytes) AS BIGINT) FROM db GROUP BY service)
        SELECT row_number() OVER (ORDER BY service, is_total, bytes DESC, database) AS position, service, database, bytes AS bytes_on_disk FROM r""",
)
def ledger_report_order(spark, sf):
    """The rows of the storage report with the place at which the report has them."""
    report = _allocation(spark, sf).storage_report().withColumn("_at", F.monotonically_increasing_id())
    return numbered(report, [], ["_at"], "position").select("position", "service", "database", "bytes_on_disk")
