"""Usage-cost ledger: flatten, validate, control totals, shares, allocation and its balance check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import json_text
from tidewell.functions.checks import check_none
from tidewell.functions.text import percent, ratio
from tidewell.operators.current import latest
from tidewell.operators.matching import left_join_filled
from tidewell.operators.totals import fixed_rows, share_of_all, share_of_group, union_labelled, unpivot_metrics

# The metrics each kind of entity may carry.
DEFAULT_METRICS = {
    "warehouse": ("storage", "backup"),
    "service": (
        "compute",
        "publicDataTransfer",
        "interRegionTier1DataTransfer",
        "interRegionTier2DataTransfer",
        "interRegionTier3DataTransfer",
        "interRegionTier4DataTransfer",
    ),
    "pipe": ("compute", "dataTransfer", "initialLoad"),
}
# Report labels of the service metrics.
CATEGORY_LABELS = {
    "compute": "compute",
    "publicDataTransfer": "public transfer",
    "interRegionTier1DataTransfer": "inter-region tier 1",
    "interRegionTier2DataTransfer": "inter-region tier 2",
    "interRegionTier3DataTransfer": "inter-region tier 3",
    "interRegionTier4DataTransfer": "inter-region tier 4",
}
# When two amounts count as equal, and how far a day may be out of balance.
RELATIVE, ABSOLUTE, BALANCE = 1e-9, 1e-6, 1e-6
FLAG_NO_LOG = "no system log"
FLAG_SCALED = "cpu above capacity: shares scaled down"

_NUMBER_KINDS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


@dataclass(frozen=True)
class LedgerSpec:
    """Names of the billing format: entity kinds with their metrics, and the unit that ends amount fields."""

    metrics: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(DEFAULT_METRICS))
    unit: str = ""
    warehouse_type: str = "warehouse"
    service_type: str = "service"

    @property
    def metric_names(self) -> list[str]:
        return list(dict.fromkeys(m for names in self.metrics.values() for m in names))

    def field(self, metric: str) -> str:
        return metric + self.unit


def same_amount(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.greatest(
        F.lit(RELATIVE) * F.greatest(F.abs(a), F.abs(b)), F.lit(ABSOLUTE)
    )


def windows(first: Column, last: Column, max_days: int = 31) -> Column:
    """An inclusive day range as an array of inclusive windows of at most ``max_days`` days."""
    starts = F.sequence(first, last, F.expr(f"INTERVAL {max_days} DAYS"))
    return F.transform(
        starts,
        lambda d: F.struct(d.cast("date").alias("from"), F.least(F.date_add(d, max_days - 1), last).alias("to")),
    )


# --- reading and validation --------------------------------------------------------------------------------


def read_responses(spark: SparkSession, path: str, spec: LedgerSpec) -> tuple[DataFrame, DataFrame]:
    """Saved responses, one JSON document per file -> (records, headers).

    Records stay raw JSON text: validation has to see the difference between a number and a quoted number.
    """
    schema = f"status INT, result STRUCT<`{spec.field('grandTotal')}`: STRING, costs: ARRAY<STRING>>"
    docs = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("window", F.input_file_name())
    records = docs.select("window", F.posexplode("result.costs").alias("position", "record"))
    headers = docs.select(
        "window", "status", F.col(f"result.{spec.field('grandTotal')}").try_cast("double").alias("grand_total"),
        F.coalesce(F.size("result.costs"), F.lit(-1)).alias("records"),
    )
    return records, headers


_FAILURES = "array<struct<rule:string,field:string,value:string>>"


def _failure(rule: str, field: Column, value: Column) -> Column:
    """A broken rule with the place it was broken at and what stood there."""
    return F.struct(F.lit(rule).alias("rule"), field.cast("string").alias("field"), value.cast("string").alias("value"))


def flatten(records: DataFrame, spec: LedgerSpec, fetched_at: Column) -> DataFrame:
    """One typed row per raw record, with the rules it breaks as an array of (rule, field, value).

    ``records`` carries (window, record).  A metric that is absent is 0, an absent text is ''.  A record
    that lacks a required field or has an unusable total has ``usable = false``.
    """
    # Variants keep a number and a quoted number apart; one parse per record.
    raw = json_text.once(records, {"_f": F.from_json("record", "map<string,variant>")})
    field = lambda name: F.try_element_at("_f", F.lit(name))
    kind_of = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    text = lambda name: F.coalesce(F.try_variant_get(field(name), "$", "string"), F.lit(""))
    given = lambda name: kind_of(field(name)) != "VOID"
    total_field = spec.field("total")
    nothing = F.create_map().cast("map<string,variant>")
    metrics = F.coalesce(F.try_variant_get(field("metrics"), "$", "map<string,variant>"), nothing)
    raw = json_text.once(raw, {"_metrics_kind": kind_of(field("metrics")), "_m": metrics})
    base = raw.select(
        "window",
        text("date").alias("_date"),
        text("entityType").alias("entity_type"),
        text("entityId").alias("entity_id"),
        text("entityName").alias("entity_name"),
        text("serviceId").alias("service_id"),
        text("dataWarehouseId").alias("warehouse_id"),
        text("organizationTier").alias("tier"),
        ((kind_of(field("locked")) == "BOOLEAN") & (text("locked") == "true")).alias("locked"),
        field(total_field).alias("_total"),
        (~given("serviceId")).alias("service_id_missing"),
        F.filter(
            F.array(*[F.when(~given(n), F.lit(n)) for n in ("date", "entityType", "entityId", total_field)]),
            lambda n: n.isNotNull(),
        ).alias("_absent"),
        "_metrics_kind",
        "_m",
    )
    allowed = F.create_map(
        *[
            part
            for kind, names in spec.metrics.items()
            for part in (F.lit(kind), F.array(*[F.lit(spec.field(n)) for n in names]))
        ]
    )
    is_number = lambda v: kind_of(v).rlike(_NUMBER_KINDS)
    number = lambda v: F.when(is_number(v), F.try_variant_get(v, "$", "double"))
    base = json_text.once(
        base,
        {
            "_known": F.try_element_at(allowed, F.col("entity_type")),
            "_who": F.concat_ws(" ", F.substring("_date", 1, 10), "entity_type", "entity_id"),
            "_dated": F.col("_date").rlike(r"^\d{4}-\d{2}-\d{2}"),
            "_shaped": (F.col("_metrics_kind") == "VOID") | F.startswith("_metrics_kind", F.lit("OBJECT")),
            "total": number(F.col("_total")),
            "_values": F.transform_values("_m", lambda _, v: number(v)),
        },
    )
    complete, dated, shaped = F.size("_absent") == 0, F.col("_dated"), F.col("_shaped")
    known, who, counted = F.col("_known"), F.col("_who"), F.col("total").isNotNull()
    usable = complete & dated & counted & shaped
    # Of a record that can't be used the first rule it breaks; of one that can, every metric at fault.
    problem = (
        F.when(~complete, _failure("missing_field", F.array_join("_absent", ","), F.col("entity_id")))
        .when(~dated, _failure("date", F.lit("date"), F.col("_date")))
        .when(~counted, _failure("total", who, F.lit(None)))
        .when(~shaped, _failure("metrics", who, F.lit(None)))
        .when(known.isNull(), _failure("entity_type", F.col("entity_type"), who))
    )
    unexpected = F.transform(
        F.filter(F.map_keys("_m"), lambda k: known.isNotNull() & ~F.array_contains(known, k)), lambda k: _failure("metric_name", k, who)
    )
    bad_value = F.transform(
        F.map_entries(F.map_filter("_m", lambda k, v: F.try_element_at("_values", k).isNull())),
        lambda e: _failure("metric_value", F.concat(who, F.lit(" "), e["key"]), F.to_json(e["value"])),
    )
    per_metric = F.when(usable, F.concat(unexpected, bad_value)).otherwise(F.array().cast(_FAILURES))
    base = json_text.once(
        base, {"usable": usable, "failures": F.concat(F.array_compact(F.array(problem)), per_metric)}
    )
    metric = lambda m: F.coalesce(F.try_element_at("_values", F.lit(spec.field(m))), F.lit(0.0))
    return base.select(
        "window",
        F.to_date(F.substring(F.when(dated, F.col("_date")), 1, 10)).alias("date"),
        "entity_type",
        "entity_id",
        "entity_name",
        "service_id",
        "warehouse_id",
        "tier",
        "locked",
        "total",
        *[metric(m).alias(m) for m in spec.metric_names],
        fetched_at.alias("fetched_at"),
        F.aggregate(
            F.map_values("_values"), F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0))
        ).alias("metric_sum"),
        "service_id_missing",
        "usable",
        "failures",
    )


def record_failures(flat: DataFrame) -> DataFrame:
    """(window, rule, field, value): the rules that records break."""
    # Outer, then a filter on what came out: an inner explode would make the optimizer infer a filter on the array and
    # copy the whole validation expression into it.
    return flat.select("window", F.explode_outer("failures").alias("f")).where(F.col("f").isNotNull()).select("window", "f.*")


def control_totals(flat: DataFrame, headers: DataFrame) -> DataFrame:
    """Per window: sum of the usable totals against the grand total of the response, and whether they agree."""
    sums = flat.groupBy("window").agg(
        F.sum(F.when(F.col("usable"), F.col("total"))).alias("sum_total"),
        F.count("*").alias("seen"),
        F.count_if("usable").alias("usable_records"),
    )
    joined = left_join_filled(headers, sums, ["window"], {"sum_total": 0.0, "seen": 0, "usable_records": 0})
    return joined.select(
        "window",
        "grand_total",
        "sum_total",
        F.col("seen").alias("records"),
        (
            (F.col("seen") == F.col("usable_records"))
            & F.coalesce(same_amount(F.col("sum_total"), F.col("grand_total")), F.lit(False))
        ).alias("agrees"),
    )


def all_failures(flat: DataFrame, headers: DataFrame) -> DataFrame:
    """Everything that stops a publication: bad responses, bad records, totals that differ."""
    bad_response = headers.where(
        F.col("grand_total").isNull() | (F.col("records") < 0) | (F.coalesce("status", F.lit(200)) != 200)
    ).select("window", _failure("response", F.lit("status"), F.col("status")).alias("f")).select("window", "f.*")
    totals = (
        control_totals(flat, headers)
        .where(~F.col("agrees") & F.col("grand_total").isNotNull())
        .select("window", _failure("grand_total", F.col("grand_total"), F.col("sum_total")).alias("f"))
        .select("window", "f.*")
    )
    return record_failures(flat).unionByName(bad_response).unionByName(totals)


def accepted_rows(flat: DataFrame, headers: DataFrame) -> DataFrame:
    """The rows to publish; raises with the failures named when there is any, so nothing half right gets out."""
    check_none(all_failures(flat, headers), "ledger not published")
    return flat.drop("window", "usable", "failures", "metric_sum", "service_id_missing")


def notes(flat: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Counts that are worth knowing and stop nothing."""
    usable = flat.where("usable")
    key = ["date", "entity_type", "entity_id"]
    checks = usable.agg(
        F.count_if(~same_amount(F.col("metric_sum"), F.col("total"))).alias("sum_differs"),
        F.count_if(F.col("service_id_missing") != (F.col("entity_type") == spec.warehouse_type)).alias("service_id_rule"),
        F.count_if(~F.col("locked")).alias("provisional_records"),
        F.count("*").alias("records"),
    )
    repeated = usable.groupBy(*key).count().where("count > 1").agg(F.count("*").alias("n")).scalar()
    return checks.select("*", repeated.alias("duplicate_keys"))


def tiers(flat: DataFrame) -> DataFrame:
    seen = F.when(F.col("tier") == "", "(absent)").otherwise(F.col("tier"))
    return flat.where("usable").groupBy(seen.alias("tier")).agg(F.count("*").alias("records"))


def current(ledger: DataFrame) -> DataFrame:
    """The ledger as read: per day and entity the row fetched last."""
    return latest(ledger, ["date", "entity_type", "entity_id"], "fetched_at")


# --- reports -----------------------------------------------------------------------------------------------


def totals_by_metric(ledger: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Totals by entity type and metric for every allowed pair, zeros included."""
    spark = ledger.sparkSession
    wanted = spark.createDataFrame(
        [(kind, m) for kind, names in spec.metrics.items() for m in names], "entity_type string, metric string"
    )
    long = unpivot_metrics(ledger, ["entity_type"], {m: m for m in spec.metric_names}, "metric", "amount")
    sums = long.groupBy("entity_type", "metric").agg(F.sum("amount").alias("amount"))
    return fixed_rows(sums, wanted, ["entity_type", "metric"], ["amount"])


def totals_by_entity(ledger: DataFrame) -> DataFrame:
    """Total and active days per entity."""
    return ledger.groupBy("entity_type", "entity_id").agg(
        F.max("entity_name").alias("entity_name"),
        F.sum("total").alias("total"),
        F.count_distinct("date").alias("days"),
    )


def provisional_days(ledger: DataFrame) -> DataFrame:
    return ledger.where(~F.col("locked")).groupBy("date").agg(
        F.count("*").alias("records"), F.sum("total").alias("total")
    )


def duplicate_keys(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("date", "entity_type", "entity_id").agg(F.count("*").alias("rows")).where("rows > 1")


def storage_and_backup(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("entity_type").agg(
        F.count("*").alias("records"), F.sum("storage").alias("storage"), F.sum("backup").alias("backup")
    )


def warehouse_backup_share(ledger: DataFrame, spec: LedgerSpec) -> DataFrame:
    grouped = ledger.where(F.col("entity_type") == spec.warehouse_type).groupBy("entity_name", "entity_id").agg(
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.sum("storage").alias("storage"),
        F.sum("backup").alias("backup"),
    )
    return grouped.withColumn("backup_pct", percent(F.col("backup"), F.col("storage") + F.col("backup"), 1))


def service_days(ledger: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Cost per service and day, each category in its column, provisional days marked."""
    return ledger.where(F.col("entity_type") == spec.service_type).select(
        F.col("entity_name").alias("service"),
        "date",
        *spec.metrics[spec.service_type],
        "total",
        F.when(F.col("locked"), "").otherwise("provisional").alias("note"),
    )


def category_shares(ledger: DataFrame, spec: LedgerSpec, per_service: bool = True) -> DataFrame:
    """Share of every category, per service or over all services."""
    labels = {m: CATEGORY_LABELS.get(m, m) for m in spec.metrics[spec.service_type]}
    services = ledger.where(F.col("entity_type") == spec.service_type).withColumnRenamed("entity_name", "service")
    groups = ["service", "category"] if per_service else ["category"]
    sums = (
        unpivot_metrics(services, ["service"], labels, "category", "amount")
        .groupBy(*groups)
        .agg(F.round(F.sum("amount"), 6).alias("amount"))
    )
    return share_of_group(sums, "amount", ["service"]) if per_service else share_of_all(sums, "amount")


def backup_summary(backups: DataFrame) -> DataFrame:
    """Per service: backups by kind and state, bytes of the finished ones, missing sizes, oldest and newest."""
    done = F.col("status") == "done"
    return backups.groupBy("service_id").agg(
        F.count("*").alias("backups"),
        F.count_if(F.col("type") == "full").alias("full"),
        F.count_if(F.col("type") == "incremental").alias("incremental"),
        F.count_if(done).alias("done"),
        F.coalesce(F.sum(F.when(done, F.col("size_bytes"))), F.lit(0)).alias("done_bytes"),
        F.count_if(done & F.col("size_bytes").isNull()).alias("done_without_size"),
        F.min("started_at").alias("oldest"),
        F.max("started_at").alias("newest"),
    )


def warehouse_backup_bill(ledger: DataFrame, spec: LedgerSpec, file_order: Sequence[str]) -> DataFrame:
    """Per service: backup cost of its warehouse, per day, and how many other services share it.

    Here the last row in file order wins per key, not the one fetched last.
    """
    rows = latest(ledger, ["date", "entity_type", "entity_id"], list(file_order))
    non_empty = lambda c: F.nullif(F.col(c), F.lit(""))
    services = (
        rows.where(F.col("entity_type") == spec.service_type)
        .groupBy(F.coalesce(non_empty("service_id"), F.col("entity_id")).alias("service"))
        .agg(
            F.max_by(non_empty("entity_name"), F.when(non_empty("entity_name").isNotNull(), F.col("date"))).alias("name"),
            F.max_by(non_empty("warehouse_id"), F.when(non_empty("warehouse_id").isNotNull(), F.col("date"))).alias("warehouse"),
        )
    )
    bills = (
        rows.where(F.col("entity_type") == spec.warehouse_type)
        .groupBy(F.coalesce(non_empty("warehouse_id"), F.col("entity_id")).alias("warehouse"))
        .agg(F.sum("backup").alias("backup"), F.count_distinct("date").alias("days"))
    )
    sharing = services.groupBy("warehouse").agg((F.count("*") - 1).alias("shared_with"))
    return (
        services.join(bills, "warehouse", "left")
        .join(sharing, "warehouse", "left")
        .withColumn("backup_per_day", ratio(F.col("backup"), F.col("days")))
    )


def run_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per step: hours x count x unit price, from a usage table and a price table."""
    return (
        usage.join(prices, "item")
        .withColumn("cost", F.col("count") * F.col("seconds") / 3600 * F.col("price_per_hour"))
        .groupBy("step")
        .agg(F.max("seconds").alias("seconds"), F.round(F.sum("cost"), 4).alias("cost"))
    )


# --- allocation --------------------------------------------------------------------------------------------
#
# All tables carry the service, so one run allocates every service; a single service is the same with
# a constant.  Amounts are shares estimated from logs times what was billed: an allocation, not a bill.


def billed_days(ledger: DataFrame, spec: LedgerSpec, first: Column, last: Column) -> DataFrame:
    """Per service and day: billed compute and the billed storage of the service's warehouse.

    A warehouse row belongs to the service whose warehouse id it carries in either id column.
    """
    in_range = ledger.where(F.col("date").between(first, last))
    services = (
        in_range.where(F.col("entity_type") == spec.service_type)
        .groupBy(F.col("service_id").alias("service"), F.col("date").alias("day"))
        .agg(
            F.min("warehouse_id").alias("warehouse_id"),
            F.count_distinct("warehouse_id").alias("_warehouses"),
            F.sum("compute").alias("compute_billed"),
            F.bool_and("locked").alias("locked"),
        )
    )
    ids = services.select(F.col("warehouse_id").alias("id")).distinct()
    # A row may match on either column; each (row, id) pair is counted once.
    storage = (
        in_range.where(F.col("entity_type") == spec.warehouse_type)
        .withColumn("wid", F.explode(F.array_distinct(F.array("warehouse_id", "entity_id"))))
        .join(ids.withColumnRenamed("id", "wid"), "wid", "left_semi")
        .groupBy(F.col("wid").alias("warehouse_id"), F.col("date").alias("day"))
        .agg(F.sum("storage").alias("storage_billed"))
    )
    return left_join_filled(services, storage, ["warehouse_id", "day"], {"storage_billed": 0.0})


def guard_billed(billed: DataFrame) -> None:
    """The service must have billed rows and one warehouse over the range."""
    per_service = billed.groupBy("service").agg(
        F.count_distinct("warehouse_id").alias("warehouses"), F.max("_warehouses").alias("on_a_day")
    )
    if billed.isEmpty():
        raise ValueError("no service rows for this service and range")
    check_none(
        per_service.where("warehouses > 1 OR on_a_day > 1").select("service"), "service with more than one warehouse"
    )


def storage_shares(parts: DataFrame) -> DataFrame:
    """Share of active bytes per service and database."""
    sizes = parts.where("active").groupBy("service", "database").agg(F.sum("bytes_on_disk").alias("bytes"))
    totals = sizes.groupBy("service").agg(F.sum("bytes").alias("_total"))
    return sizes.join(totals, "service").select(
        "service",
        "database",
        "bytes",
        F.when(F.col("_total") > 0, F.col("bytes") / F.col("_total")).otherwise(0.0).alias("share"),
    )


def allocate_storage(billed: DataFrame, shares: DataFrame) -> DataFrame:
    """Every day's storage amount spread by the same shares; an equality join on the service."""
    return billed.select("service", "day", "storage_billed").join(shares, "service").select(
        "service", "day", "database", "bytes", (F.col("share") * F.col("storage_billed")).alias("allocated")
    )


def split_shared(billed: DataFrame, shares: DataFrame) -> DataFrame:
    """``billed`` with the storage of a warehouse that several services share split among them, by their active bytes of
    that day's services; evenly when none has any. A warehouse of one service stays with it whole."""
    sizes = shares.groupBy("service").agg(F.sum("bytes").alias("_bytes"))
    sharing = Window.partitionBy("warehouse_id", "day")
    sized = left_join_filled(billed, sizes, ["service"], {"_bytes": 0}).withColumn("_all", F.sum("_bytes").over(sharing))
    part = F.when(F.col("_all") > 0, F.col("_bytes") / F.col("_all")).otherwise(1 / F.count("*").over(sharing))
    return sized.withColumn("storage_billed", F.col("storage_billed") * part).drop("_bytes", "_all")


def table_shares(parts: DataFrame, billed: DataFrame) -> DataFrame:
    """Every table's bytes, its share of its service's active bytes and that share of the service's storage billed."""
    sizes = parts.where("active").groupBy("service", "database", "table").agg(F.sum("bytes_on_disk").alias("bytes"))
    totals = sizes.groupBy("service").agg(F.sum("bytes").alias("_total"))
    amounts = billed.groupBy("service").agg(F.sum("storage_billed").alias("_amount"))
    share = ratio(F.col("bytes"), F.col("_total"))
    return (
        sizes.join(totals, "service").join(amounts, "service", "left")
        .select("service", "database", "table", "bytes", share.alias("share"), (share * F.coalesce("_amount", F.lit(0.0))).alias("allocated"))
    )


def largest_tables(parts: DataFrame, billed: DataFrame, count: int = 50) -> DataFrame:
    """The largest tables with their share of their service's active bytes and of its storage billed."""
    return (
        table_shares(parts, billed)
        .select("service", "database", "table", "bytes", F.round(100 * F.col("share"), 2).alias("share_pct"), F.round("allocated", 6).alias("allocated_storage"))
        .orderBy(F.col("bytes").desc(), "service", "database", "table")
        .limit(count)
    )


def reconciled(parts: DataFrame, billed: DataFrame, storage: DataFrame) -> DataFrame:
    """Per service and database what its tables add up to and what the allocation gave it."""
    tables = table_shares(parts, billed).groupBy("service", "database").agg(F.sum("allocated").alias("by_tables"))
    allocated = storage.groupBy("service", "database").agg(F.sum("allocated").alias("by_allocation"))
    both = tables.join(allocated, ["service", "database"], "full_outer").select(
        "service", "database", F.coalesce("by_tables", F.lit(0.0)).alias("by_tables"), F.coalesce("by_allocation", F.lit(0.0)).alias("by_allocation")
    )
    near = F.abs(F.col("by_tables") - F.col("by_allocation")) <= ABSOLUTE + RELATIVE * F.abs("by_allocation")
    return both.withColumn("agrees", near)


def user_cpu(log: DataFrame, first: Column, last: Column) -> DataFrame:
    """CPU seconds per service, day (UTC) and user from finished and failed statements.

    ``counters`` is a map; a counter that is absent is 0.
    """
    micros = lambda name: F.coalesce(F.try_element_at("counters", F.lit(name)), F.lit(0))
    at = F.col("event_time")
    return (
        log.where(F.col("type").isin("QueryFinish", "ExceptionWhileProcessing"))
        .where((at >= first.cast("timestamp")) & (at < F.date_add(last, 1).cast("timestamp")))
        .groupBy("service", F.to_date(at).alias("day"), "user")
        .agg((F.sum(micros("UserTimeMicroseconds") + micros("SystemTimeMicroseconds")) / F.lit(1e6)).alias("cpu_s"))
    )


def capacity(samples: DataFrame, metric: str, first: Column, last: Column) -> DataFrame:
    """Core-seconds per service and day: sum over hosts of sampled cores x median gap between samples.

    Samples of one second are added up before the gaps are taken.  That changes no positive gap, and it bounds a
    (host, day) group by the 86,400 seconds of a day however many samples there are.
    """
    at = F.col("event_time")
    seconds = (
        samples.where(F.col("metric") == metric)
        .where((at >= first.cast("timestamp")) & (at < F.date_add(last, 1).cast("timestamp")))
        .groupBy("service", "hostname", F.to_date(at).alias("day"), F.unix_timestamp(at).alias("second"))
        .agg(F.count("*").alias("_n"), F.sum("value").alias("_value"))
    )
    order = Window.partitionBy("service", "hostname", "day").orderBy("second")
    gaps = seconds.withColumn("gap_s", F.col("second") - F.lag("second", 1).over(order))
    per_host = gaps.groupBy("service", "hostname", "day").agg(
        F.sum("_n").alias("samples"),
        (
            F.sum("_value") * F.coalesce(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY gap_s) FILTER (WHERE gap_s > 0)"), F.lit(0))
        ).alias("core_seconds"),
    )
    return per_host.groupBy("service", "day").agg(
        F.count("*").alias("replicas"), F.sum("samples").alias("samples"), F.sum("core_seconds").alias("capacity_s")
    )


def rate_days(billed: DataFrame, cpu: DataFrame, cap: DataFrame) -> DataFrame:
    """One row per service and day: what a CPU second is worth, the part nobody used, and a flag.

    The rate is billed over capacity, or over the CPU seconds themselves when they exceed it.
    """
    used = cpu.groupBy("service", "day").agg(F.sum("cpu_s").alias("cpu_s"))
    joined = left_join_filled(billed, used, ["service", "day"], {"cpu_s": 0.0})
    joined = left_join_filled(
        joined, cap.select("service", "day", "replicas", "capacity_s"), ["service", "day"], {"replicas": 0, "capacity_s": 0.0}
    )
    room, used_s, billed_c = F.col("capacity_s"), F.col("cpu_s"), F.col("compute_billed")
    return (
        joined.withColumn(
            "flag",
            F.when((billed_c > 0) & (room <= 0), FLAG_NO_LOG).when(used_s > room, FLAG_SCALED).otherwise(""),
        )
        .withColumn("per_cpu_s", F.when(room > 0, billed_c / F.greatest(room, used_s)).otherwise(0.0))
        .withColumn(
            "compute_unallocated",
            F.when(room > 0, billed_c * (1 - F.least(F.lit(1.0), used_s / room))).otherwise(billed_c),
        )
    )


def allocate_compute(cpu: DataFrame, days: DataFrame) -> DataFrame:
    return cpu.join(days.select("service", "day", "per_cpu_s"), ["service", "day"]).select(
        "service", "day", "user", "cpu_s", (F.col("cpu_s") * F.col("per_cpu_s")).alias("allocated")
    )


def compute_report(allocated: DataFrame, days: DataFrame) -> DataFrame:
    """Per user the share of the compute billed, then what no statement explains, then the total."""
    total = days.agg(F.sum("compute_billed").alias("t")).scalar()
    users = allocated.groupBy(F.col("user").alias("who")).agg(
        F.sum("cpu_s").alias("cpu_s"), F.sum("allocated").alias("amount"), F.lit("").alias("note")
    )
    silent = F.count_if(F.col("flag") == FLAG_NO_LOG)
    rest = days.agg(
        F.sum("compute_unallocated").alias("amount"),
        F.when(silent > 0, F.concat(F.lit("includes "), silent.cast("string"), F.lit(" day(s) flagged no system log")))
        .otherwise("")
        .alias("note"),
    ).select(F.lit("unallocated").alias("who"), F.lit(0.0).alias("cpu_s"), "amount", "note")
    whole = days.agg(F.sum("compute_billed").alias("amount")).select(
        F.lit("total billed").alias("who"), F.lit(0.0).alias("cpu_s"), "amount", F.lit("").alias("note")
    )
    rows = union_labelled({"0": users, "1": rest, "2": whole}, "position")
    return rows.select(
        F.col("position").cast("int").alias("position"),
        "who",
        F.round("cpu_s", 1).alias("cpu_seconds"),
        F.round("amount", 6).alias("amount"),
        percent(F.col("amount"), total).alias("share_pct"),
        "note",
    ).orderBy("position", F.desc("amount"), "who")


def balance(days: DataFrame, compute: DataFrame, storage: DataFrame) -> DataFrame:
    """Per service and day billed, allocated, unallocated and the differences.

    The unallocated part is a closed form per day, the allocation is built per user: the comparison is between two
    separate computations.
    """
    c = compute.groupBy("service", "day").agg(F.sum("allocated").alias("compute_allocated"))
    s = storage.groupBy("service", "day").agg(F.sum("allocated").alias("storage_allocated"))
    out = left_join_filled(days, c, ["service", "day"], {"compute_allocated": 0.0})
    out = left_join_filled(out, s, ["service", "day"], {"storage_allocated": 0.0})
    return out.select(
        "service",
        "day",
        "compute_billed",
        "compute_allocated",
        "compute_unallocated",
        (F.col("compute_billed") - F.col("compute_allocated") - F.col("compute_unallocated")).alias("compute_diff"),
        "storage_billed",
        "storage_allocated",
        (F.col("storage_billed") - F.col("storage_allocated")).alias("storage_diff"),
        "replicas",
        "capacity_s",
        "cpu_s",
        F.when(F.col("locked"), "").otherwise("provisional").alias("provisional"),
        "flag",
    )


def assert_balanced(checked: DataFrame, tolerance: float = BALANCE) -> None:
    """Raise, naming the days, unless billed = allocated + unallocated on every day; amounts in the millions may differ by
    what double arithmetic loses of them."""
    allowed = lambda billed: F.lit(tolerance) + RELATIVE * F.abs(billed)
    off = checked.where((F.abs("compute_diff") > allowed("compute_billed")) | (F.abs("storage_diff") > allowed("storage_billed")))
    check_none(off.select("service", "day", "compute_diff", "storage_diff"), "billed differs from allocated + unallocated")
