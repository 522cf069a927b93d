import json
import os

import pytest
from pyspark.sql import functions as F

from tidewell.functions.checks import CheckFailed
from tidewell.operators import ledger as L
from tidewell.operators.totals import union_matching
from tidewell.plans.allocation import allocate

SPEC = L.LedgerSpec()
W, A, B, P = "w-1", "svc-a", "svc-b", "pipe-a"
# (day, locked, storage, backup, compute a, transfer a, tier1 a, tier2 a, tier3 a, tier4 a, compute b, transfer b, tier1 b, pipe compute, pipe transfer, pipe load)
DAYS = [
    ("2026-09-29", True, 10.0, 1.0, 40.0, 2.0, 0.5, 0.2, 0.0, 0.0, 12.0, 0.5, 0.1, 3.0, 0.4, 0.0),
    ("2026-09-30", True, 10.5, 1.0, 48.0, 3.0, 0.5, 0.3, 0.1, 0.0, 12.0, 0.5, 0.1, 3.0, 0.4, 1.2),
    ("2026-10-01", False, 10.25, 1.25, 24.0, 1.0, 0.25, 0.1, 0.0, 0.05, 6.0, 0.25, 0.05, 1.5, 0.2, 0.0),
]


def record(day, locked, kind, entity, name, service, metrics):
    return {
        "date": day, "dataWarehouseId": W, "serviceId": service, "entityType": kind, "entityId": entity, "entityName": name,
        "organizationTier": "tier-a", "locked": locked, "metrics": metrics, "total": sum(metrics.values()),
    }


def records():
    out = []
    for d, ok, st, bk, ca, ta, a1, a2, a3, a4, cb, tb, b1, pc, pt, pl in DAYS:
        tiers = lambda *v: {f"interRegionTier{i + 1}DataTransfer": x for i, x in enumerate(v)}
        out += [
            record(d, ok, "warehouse", W, "warehouse-a", None, {"storage": st, "backup": bk}),
            record(d, ok, "service", A, "service-a", A, {"compute": ca, "publicDataTransfer": ta, **tiers(a1, a2, a3, a4)}),
            record(d, ok, "service", B, "service-b", B, {"compute": cb, "publicDataTransfer": tb, **tiers(b1, 0.0, 0.0, 0.0)}),
            record(d, ok, "pipe", P, "pipe-a", A, {"compute": pc, "dataTransfer": pt, "initialLoad": pl}),
        ]
    return out


def response(spark, folder, rows, grand=195.2, name="a.json", status=200):
    with open(os.path.join(folder, name), "w") as f:
        json.dump({"status": status, "requestId": "r", "result": {"grandTotal": grand, "costs": rows}}, f, indent=1)
    raw, headers = L.read_responses(spark, folder, SPEC)
    return L.flatten(raw, SPEC, F.lit("2026-10-02 00:00:00").cast("timestamp")), headers


@pytest.fixture()
def ledger(spark, folder):
    flat, headers = response(spark, folder, records())
    return L.accepted_rows(flat, headers)


def test_good_response(spark, folder):
    flat, headers = response(spark, folder, records())
    assert L.all_failures(flat, headers).count() == 0
    rows = L.accepted_rows(flat, headers)
    assert rows.count() == 12 and round(rows.agg(F.sum("total")).first()[0], 6) == 195.2
    assert rows.where("service_id = ''").count() == 3
    assert [(str(r.date), r.records) for r in L.provisional_days(rows).collect()] == [("2026-10-01", 4)]
    note = L.notes(flat, SPEC).first()
    assert (note.sum_differs, note.service_id_rule, note.duplicate_keys) == (0, 0, 0)


@pytest.mark.parametrize(
    "change, words",
    [
        (lambda r: r[1]["metrics"].update(storage=0.0), r"metric_name \| storage"),
        (lambda r: r[1].update(entityType="mystery"), r"entity_type \| mystery"),
        (lambda r: r[1]["metrics"].update(compute="40"), r"metric_value \| .* compute \| \"40\""),
        (lambda r: r[1]["metrics"].update(compute=True), r"metric_value \| .* compute \| true"),
        (lambda r: r[1].update(metrics=[1]), r"\| metrics \|"),
        (lambda r: r[1].update(total="42.7"), r"\| total \|"),
        (lambda r: r[1].update(entityId=None), r"missing_field \| entityId"),
        (lambda r: r[1].update(date="29.09.2026"), r"date \| date \| 29.09.2026"),
    ],
)
def test_faults_are_named_and_nothing_is_published(spark, folder, change, words):
    rows = records()
    change(rows)
    flat, headers = response(spark, folder, rows)
    with pytest.raises(CheckFailed, match=words):
        L.accepted_rows(flat, headers)


def test_wrong_grand_total_and_bad_status(spark, folder):
    flat, headers = response(spark, folder, records(), grand=195.3)
    with pytest.raises(CheckFailed, match=r"grand_total \| 195.3"):
        L.accepted_rows(flat, headers)
    flat, headers = response(spark, folder, records(), status=500)
    with pytest.raises(CheckFailed, match=r"response \| status \| 500"):
        L.accepted_rows(flat, headers)


def test_two_equal_windows(spark, folder):
    response(spark, folder, records())
    flat, headers = response(spark, folder, records(), name="b.json")
    rows = L.accepted_rows(flat, headers)
    assert rows.count() == 24 and L.duplicate_keys(rows).count() == 12 and L.current(rows).count() == 12


def test_windows_of_31_days(spark):
    w = lambda a, b: [
        (str(x["from"]), str(x["to"]))
        for x in spark.range(1).select(L.windows(F.lit(a).cast("date"), F.lit(b).cast("date")).alias("w")).first().w
    ]
    assert w("2026-01-01", "2026-01-31") == [("2026-01-01", "2026-01-31")]
    assert w("2026-01-01", "2026-02-01") == [("2026-01-01", "2026-01-31"), ("2026-02-01", "2026-02-01")]
    assert w("2026-01-05", "2026-01-05") == [("2026-01-05", "2026-01-05")]


def test_reports(spark, ledger):
    shares = {(r.service, r.category): r.share_pct for r in L.category_shares(ledger, SPEC).collect()}
    assert shares["service-a", "compute"] == round(100 * 112 / 120, 2) and len(shares) == 12
    assert sum(r.share_pct for r in L.category_shares(ledger, SPEC, per_service=False).collect()) == pytest.approx(100, abs=0.05)
    totals = {(r.entity_type, r.metric): r.amount for r in L.totals_by_metric(ledger, SPEC).collect()}
    assert totals["warehouse", "storage"] == 30.75 and totals["pipe", "initialLoad"] == pytest.approx(1.2) and len(totals) == 11
    bill = {r.service: r for r in L.warehouse_backup_bill(ledger, SPEC, ["fetched_at"]).collect()}
    assert bill[A].backup == 3.25 and bill[A].days == 3 and bill[A].shared_with == 1
    assert bill[A].backup_per_day == pytest.approx(3.25 / 3)


def test_backup_summary(spark):
    rows = [
        ("s", "in_progress", "incremental", None, "2026-10-01T06:00:00"), ("s", "done", "incremental", 2097152, "2026-09-30T06:00:00"),
        ("s", "error", "incremental", None, "2026-09-29T06:00:00"), ("s", "done", "full", 1073741824, "2026-09-28T06:00:00"),
    ]
    r = L.backup_summary(spark.createDataFrame(rows, "service_id string, status string, type string, size_bytes bigint, started_at string")).first()
    assert (r.backups, r.full, r.incremental, r.done_bytes, r.done_without_size) == (4, 1, 3, 1075838976, 0)


# --- allocation: the fixture days -----------------------------------------------------------------------------


def logs(spark, suffix=""):
    schema = "service string, type string, event_time timestamp, user string, u bigint, s bigint"
    counters = F.create_map(F.lit("UserTimeMicroseconds"), F.col("u"), F.lit("SystemTimeMicroseconds"), F.col("s"))
    first = [
        (A, "QueryFinish", "2026-09-29 10:00:00", "alice", 800_000_000, 100_000_000),
        (A, "QueryStart", "2026-09-29 10:00:00", "alice", 999_000_000_000, 0),
        (A, "ExceptionBeforeStart", "2026-09-29 10:00:01", "alice", 999_000_000_000, 0),
        (A, "QueryFinish", "2026-09-29 11:00:00", "bob", 150_000_000, 0),
        (A, "QueryFinish", "2026-09-30 09:00:00", "alice", 4_000_000_000, 500_000_000),
        (A, "QueryFinish", "2026-09-30 23:59:59", "bob", 1_500_000_000, 0),
        (A, "QueryFinish", "2026-10-01 08:00:00", "carol", 100_000_000, 0),
        (A, "QueryFinish", "2026-09-28 23:59:59", "dave", 777_000_000, 0),
        (A, "QueryFinish", "2026-10-02 00:00:00", "dave", 777_000_000, 0),
    ]
    rotated = [(A, "ExceptionWhileProcessing", "2026-09-29 23:30:00", "bob", 100_000_000, 50_000_000)]
    decoy = [(A, "QueryFinish", "2026-09-29 10:00:00", "mallory", 900_000_000_000, 0)]
    for name, rows in (("t_query_log", first), ("t_query_log_1", rotated), ("t_query_log_copy", decoy)):
        df = spark.createDataFrame([(a, t, x, u, i, j) for a, t, x, u, i, j in rows], schema.replace("timestamp", "string"))
        df.withColumn("event_time", F.col("event_time").cast("timestamp")).withColumn("counters", counters).drop("u", "s").createOrReplaceTempView(name)
    samples = [
        (A, h, f"{d} 00:{m:02d}:00", "CGroupMaxCPU", 4.0)
        for h in ("replica-a", "replica-b") for d in ("2026-09-29", "2026-09-30") for m in range(10)
    ] + [(A, "replica-a", f"{d} 00:{m:02d}:00", "Uptime", 99999.0) for d in ("2026-09-29", "2026-10-01") for m in range(10)]
    sampled = spark.createDataFrame(samples, "service string, hostname string, event_time string, metric string, value double")
    parts = spark.createDataFrame(
        [(A, "db_a", "t1", 400, True), (A, "db_a", "t2", 200, True), (A, "db_a", "t1", 5000, False), (A, "db_b", "t3", 300, True), (A, "system", "log", 100, True)],
        'service string, database string, "table" string, bytes_on_disk bigint, active boolean'.replace('"table"', "`table`"),
    )
    return union_matching(spark, r"t_query_log(_[0-9]+)?"), sampled.withColumn("event_time", F.col("event_time").cast("timestamp")), parts


def run(spark, ledger, parts=None, statements=None, check=True):
    log, samples, default_parts = logs(spark)
    day = lambda t: F.lit(t).cast("date")
    return allocate(
        ledger.where(F.col("entity_id") != B), default_parts if parts is None else parts, log if statements is None else statements,
        samples, day("2026-09-29"), day("2026-10-01"), SPEC, check=check,
    )


def test_allocation_numbers(spark, ledger):
    a = run(spark, ledger)
    used = {(str(r.day), r.user): r.allocated for r in a.compute.collect()}
    assert used == {
        ("2026-09-29", "alice"): 7.5, ("2026-09-29", "bob"): 2.5, ("2026-09-30", "alice"): 36.0, ("2026-09-30", "bob"): 12.0, ("2026-10-01", "carol"): 0.0,
    }
    days = {str(r.day): r for r in a.days.collect()}
    assert (days["2026-09-29"].capacity_s, days["2026-09-29"].replicas) == (4800.0, 2)
    assert [days[d].compute_unallocated for d in sorted(days)] == [30.0, 0.0, 24.0]
    assert [days[d].flag for d in sorted(days)] == ["", L.FLAG_SCALED, L.FLAG_NO_LOG]
    stored = {r.database: r.s for r in a.storage.groupBy("database").agg(F.sum("allocated").alias("s")).collect()}
    assert stored == pytest.approx({"db_a": 18.45, "db_b": 9.225, "system": 3.075})
    report = a.storage_report().collect()  # in its own order, the total last
    assert [r.database for r in report] == ["db_a", "db_b", "system", "total"] and report[-1].allocated_storage == 30.75
    assert report[-1].share_pct == 100
    lines = a.compute_report().collect()
    assert [r.position for r in lines] == sorted(r.position for r in lines) and lines[-1].who == "total billed"
    who = {r.who: r for r in lines}
    assert who["unallocated"].note == "includes 1 day(s) flagged no system log" and "mallory" not in who


def test_a_shared_warehouse_is_billed_once(spark):
    billed = spark.createDataFrame([("a", 1, "w", 10.0), ("b", 1, "w", 10.0), ("a", 2, "w", 6.0), ("c", 1, "v", 5.0), ("d", 3, "x", 4.0), ("e", 3, "x", 4.0)], "service string, day int, warehouse_id string, storage_billed double")
    shares = spark.createDataFrame([("a", 300), ("a", 450), ("b", 250), ("c", 0)], "service string, bytes bigint")
    got = {(r.service, r.day): r.storage_billed for r in L.split_shared(billed, shares).collect()}
    assert got == {("a", 1): 7.5, ("b", 1): 2.5, ("a", 2): 6.0, ("c", 1): 5.0, ("d", 3): 2.0, ("e", 3): 2.0}


def test_no_active_parts_fails_the_balance(spark, ledger):
    _, _, parts = logs(spark)
    with pytest.raises(CheckFailed, match="billed differs"):
        run(spark, ledger, parts=parts.where("NOT active"))


def test_a_too_wide_pattern_reads_the_decoy(spark, ledger):
    logs(spark)
    wide = run(spark, ledger, statements=union_matching(spark, r"t_query_log.*"), check=False)
    assert wide.compute.where("user = 'mallory'").count() == 1


def test_unknown_service_stops_at_the_guard(spark, ledger):
    with pytest.raises(ValueError, match="no service rows"):
        run(spark, ledger.where("entity_type = 'warehouse'"))


def test_storage_matches_on_either_id(spark, ledger):
    only_entity = ledger.withColumn("warehouse_id", F.when(F.col("entity_type") == "service", F.col("warehouse_id")).otherwise(""))
    first, last = F.lit("2026-09-29").cast("date"), F.lit("2026-10-01").cast("date")
    for version in (ledger, only_entity):
        billed = L.billed_days(version, SPEC, first, last).where(F.col("service") == A)
        assert billed.agg(F.sum("storage_billed")).first()[0] == 30.75
