"""Commit statistics, days by digest, levels of partial results, and scans in blocks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.operators import current, days, matching, scan
from tidewell.sources import commits, lake
from tidewell.streaming import levels

SCHEMA = "id long, version long, at timestamp_ntz, v string"
KEYS = ["id", "version"]


def _rows(spark, first, last, version=0):
    """One row a second."""
    at = F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz")
    return spark.range(first, last).select("id", F.lit(version).cast("long").alias("version"), at.alias("at"), F.col("id").cast("string").alias("v"))


def test_increment_opens_no_file_outside_the_overlap(spark, folder):
    root = f"{folder}/t"
    commits.create(spark, root)
    for k in range(6):
        commits.commit(_rows(spark, 1000 * k, 1000 * (k + 1)).coalesce(2), root, KEYS, "at", f"c{k}")
    source = _rows(spark, 0, 6500).unionByName(_rows(spark, 5990, 6000, 1))
    fresh = commits.increment(source, root, KEYS, "at")
    opened = {f for f in commits.read(spark, root, source.schema).inputFiles() if "/data/commit=" in f}
    assert sorted((r.id, r.version) for r in fresh.collect()) == [*((i, 1) for i in range(5990, 6000)), *((i, 0) for i in range(6000, 6500))]
    plan_files = [f for f in fresh.inputFiles() if "/data/commit=" in f]
    assert {f.split("/commit=")[1].split("/")[0] for f in plan_files} == {"c5"} and len(plan_files) == 1 < len(opened)
    commits.commit(fresh, root, KEYS, "at", "run")
    again = commits.increment(source, root, KEYS, "at")
    assert again.count() == 0
    held = commits.read(spark, root, source.schema)
    assert held.count() == held.select(*KEYS).distinct().count() == 6510


def test_filters_pass_over_files_without_the_keys_and_miss_none(spark, folder):
    """All commits span the same time, so only the filters tell them apart."""
    root, rng = f"{folder}/t", random.Random(3)
    commits.create(spark, root)
    of = {i: rng.randrange(5) for i in range(4000)}
    owner = spark.createDataFrame([(i, k) for i, k in of.items()], "id long, k int")
    every = _rows(spark, 0, 4000).join(owner, "id")
    for k in range(5):
        commits.commit(every.where(F.col("k") == k).drop("k").coalesce(1), root, KEYS, "at", f"c{k}")
    for k in range(5):
        asked = every.where((F.col("k") == k) & (F.col("id") % 200 < 3)).drop("k")
        files = commits.files_that_may_hold(asked, root, KEYS, "at", "timestamp_ntz")
        assert any(f"commit=c{k}/" in f for f in files) and len(files) <= 3
        assert commits.missing(asked, root, KEYS, "at").count() == 0
    strangers = _rows(spark, 0, 4000, 9).where("id % 1000 = 0")
    assert len(commits.files_that_may_hold(strangers, root, KEYS, "at", "timestamp_ntz")) <= 1
    assert commits.missing(strangers, root, KEYS, "at").count() == 4


def test_commits_without_rows_lost_and_repeated(spark, folder):
    root, source = f"{folder}/t", _rows(spark, 0, 100)
    commits.create(spark, root)
    assert commits.read(spark, root, source.schema).count() == 0
    assert commits.increment(source, root, KEYS, "at").count() == 100
    commits.commit(source.limit(0), root, KEYS, "at", "none")
    source.write.parquet(f"{root}/data/commit=lost")  # written, then the job died
    assert commits.increment(source, root, KEYS, "at").count() == 100
    for _ in range(2):
        commits.commit(source, root, KEYS, "at", "one")
    assert commits.read(spark, root, source.schema).count() == 100 and commits.increment(source, root, KEYS, "at").count() == 0


def test_days_that_differ_are_written_and_no_others(spark, folder):
    source, target, ledger = (f"{folder}/{n}" for n in ("s", "t", "l"))
    schema = "dt string, id long, v string"

    def write(rows, mode="overwrite"):
        spark.createDataFrame(rows, schema).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(source)
        spark.catalog.refreshByPath(source)

    def load(n):
        got = days.reconcile(lake.scan_lake(spark, source, "parquet", schema=schema), target, ledger, n).collect()
        spark.catalog.refreshByPath(target)
        return {r.dt: r.was_loaded for r in got}

    held = lambda: Counter(tuple(r) for r in lake.scan_lake(spark, target, "parquet", schema=schema).select("dt", "id", "v").collect())
    rows = {d: [(d, i, None if i % 3 else "x") for i in range(5)] for d in ("d1", "d2", "d3")}
    write(sum(rows.values(), []))
    assert load(0) == {"d1": False, "d2": False, "d3": False}
    assert load(1) == {}
    write([("d2", 99, "late")], "append")
    write(rows["d3"][::-1])  # same rows in other files
    rows["d2"].append(("d2", 99, "late"))
    assert load(2) == {"d2": True}
    rows["d1"][0], rows["d4"] = ("d1", 0, "corrected"), [("d4", 1, None)]
    write(rows["d1"] + rows["d4"])
    assert load(3) == {"d1": True, "d4": False}
    rows["d3"].append(rows["d3"][0])  # a row twice is not the row once
    write(rows["d3"])
    assert load(4) == {"d3": True} and load(5) == {}
    assert held() == Counter(sum(rows.values(), []))


def _counts(spark, values):
    return spark.createDataFrame([(v, 1) for v in values], "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))


def _merge(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


@pytest.mark.parametrize("fan_out", [2, 3])
def test_levels_count_every_batch_once(spark, folder, fan_out):
    root, rng, want = f"{folder}/l", random.Random(fan_out), Counter()
    merges = 0
    for b in range(10):
        values = [rng.randrange(5) for _ in range(20)]
        want.update(values)

        def breaking(df):
            raise RuntimeError("lost in the middle of a merge")

        try:
            levels.add(_counts(spark, values), b, root, breaking, fan_out)
        except RuntimeError:
            merges += 1
            levels.add(_counts(spark, values), b, root, _merge, fan_out)
        if b % 3 == 0:
            levels.add(_counts(spark, values), b, root, _merge, fan_out)  # sent again
        state, parts = levels.live(spark, root)
        spans = [(p.first, p.last) for p in parts]
        assert spans[0][0] == 0 and spans[-1][1] == b and all(x[1] + 1 == y[0] for x, y in zip(spans, spans[1:]))
        assert max(Counter(p.level for p in parts).values()) < fan_out
    got = {r.k: r.n for r in _merge(levels.read(spark, root, "k int, n long")).collect()}
    assert got == want and merges
    assert levels.replaced(spark, root, "k int, n long").count() > 0
    assert levels.read(spark, f"{folder}/none", "k int, n long").count() == 0


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_scans_against_brute_force(spark, blocks):
    rng = random.Random(blocks)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(40), rng.choice([None, None, i]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "who string, at int, v int, id int")
    got = scan.numbered(df, ["who"], ["at", "id"], "n", blocks).collect()
    carried = {r.id: r.c for r in scan.carried(df, ["who"], ["at", "id"], F.col("v"), "c", blocks).collect()}
    after = {r.id: r.f for r in scan.following(df, ["who"], ["at", "id"], "at", "f", blocks).collect()}
    numbers = {r.id: r.n for r in got}
    assert len(got) == 400
    for who in ("a", "b", None):
        last, own = None, sorted((r[1], r[3], r[2]) for r in rows if r[0] == who)
        for n, (at, i, v) in enumerate(own, 1):
            last = v if v is not None else last
            assert (numbers[i], carried[i], after[i]) == (n, last, own[n][0] if n < len(own) else None)
    assert scan.numbered(df.limit(0), ["who"], ["at"], "n", blocks).count() == 0


def test_a_burst_of_one_user_is_split(spark):
    """All events in one second of one user: blocks stay even, and every event finds its mark."""
    at = F.timestamp_seconds(F.lit(1_700_000_000)).cast("timestamp_ntz")
    events = spark.range(20_000).select(F.lit("u").alias("who"), at.alias("ts"), F.col("id").alias("e"))
    marks = spark.createDataFrame([("u", -5, "old"), ("u", 0, "now"), ("u", 9, "later")], "who string, s int, name string")
    marks = marks.select("who", F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz").alias("m"), "name")
    blocks = scan.in_blocks(events, ["who"], ["ts"], 8)
    assert blocks.groupBy(scan.BLOCK).count().agg(F.max("count")).first()[0] < 20_000 / 4
    got = matching.attribute_to_marks(events, marks, "ts", "m", "name", ["who"], 8)
    assert {(r.name, r["count"]) for r in got.groupBy("name").count().collect()} == {("now", 20_000)}


def test_repeated_staged_rows_and_changes(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    staged = spark.createDataFrame([(1, None, 5, 1), (1, "x", 7, 2), (1, "w", 6, 2), (9, "z", 0, 3)], "k int, s string, n int, at int")
    assert sorted(map(tuple, current.update_from(base, staged, ["k"], ["s", "n"], "at").collect())) == [(1, "x", 7), (2, "b", 2)]
    log = spark.createDataFrame([(1, "a", 4), (2, "b", 0)], "k int, s string, version long")
    changes = spark.createDataFrame([(1, "c", 2), (1, "d", 1), (3, "e", 1), (3, "f", 2)], "k int, s string, at int")
    got = current.upsert(log, changes, ["k"], "version", ["at"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 4), (1, "c", 6), (1, "d", 5), (2, "b", 0), (3, "e", 0), (3, "f", 1)]


def test_rows_without_a_key_wait_and_come_once(spark, folder):
    root, none = f"{folder}/t", _rows(spark, 0, 0)
    commits.create(spark, root)
    entries = lambda *parities: spark.createDataFrame([(p,) for p in parities], "v string")
    source = _rows(spark, 0, 1000).withColumn("v", F.when(F.col("id") % 4 == 0, "late").otherwise("known"))
    ready, waiting = commits.increment_with_keys(source, root, none, entries("known"), "v", KEYS, "at")
    waiting.select(*source.columns).write.parquet(f"{folder}/pending")
    commits.commit(ready.select(*source.columns), root, KEYS, "at", "one")
    pending = spark.read.parquet(f"{folder}/pending")
    assert (ready.count(), pending.count()) == (750, 250)
    ready, waiting = commits.increment_with_keys(source, root, pending, entries("known", "late"), "v", KEYS, "at")
    commits.commit(ready.select(*source.columns), root, KEYS, "at", "two")
    held = commits.read(spark, root, source.schema)
    assert held.count() == held.select(*KEYS).distinct().count() == 1000 and waiting.count() == 0
    ready, waiting = commits.increment_with_keys(source, root, pending, entries("known", "late"), "v", KEYS, "at")
    assert ready.count() == waiting.count() == 0
