import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions import ciphers, text
from tidewell.operators import current, keys, logs, masking, matching, quality, totals
from tidewell.plans import serving
from tidewell.sources import generators


def test_contained_keys_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    docs = [(i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(80)]
    docs += [(100 + i, "the same hot text with a secret deadbeef0123456789 in it") for i in range(60)] + [(200, ""), (201, None), (202, "ÄÖ Straße 한글 텍스트")]
    found = [d[1] for d in docs if d[1]]
    ks = ["a", "b c", "deadbeef0123456789", "DEADBEEF", "한글", "straße", "zz", "not there at all, however long the key is made"]
    for _ in range(60):
        t = rng.choice(found)
        at = rng.randrange(len(t))
        ks.append(t[at : at + rng.randint(1, 70)])
    ks = [(i, k) for i, k in enumerate(ks)] + [(900, ks[2]), (901, "")]
    hits = matching.key_hits(
        spark.createDataFrame(docs, "id bigint, t string"), "id", "t", spark.createDataFrame(ks, "k bigint, x string"), "k", "x"
    ).collect()
    want = {i: sum(1 for _, t in docs if t and k and k.lower() in t.lower()) for i, k in ks}
    assert {r.k: r.hits for r in hits} == want


@pytest.mark.parametrize("by", [[], ["u"]])
def test_attribution_against_brute_force(spark, by):
    rng = random.Random(3)
    events = [(i, rng.randrange(4), rng.choice([5000, rng.randrange(20_000)])) for i in range(600)]
    marks = sorted({(rng.randrange(4), rng.randrange(20_000)) for _ in range(40)} | {(1, 5000)})
    if not by:
        marks = [(0, s) for s in sorted({m[1] for m in marks})]
    at = lambda df, c: df.withColumn(c, F.timestamp_seconds(F.col(c)))
    ev = at(spark.createDataFrame(events, "e bigint, u bigint, ts bigint"), "ts")
    mk = spark.createDataFrame([(i, *m) for i, m in enumerate(marks)], "name bigint, u bigint, m bigint")
    mk = at(mk if by else mk.drop("u"), "m")
    got = matching.attribute_to_marks(ev, mk, "ts", "m", "name", by, blocks=7).collect()
    want = {}
    for e, u, ts in events:
        before = [(m[1], i) for i, m in enumerate(marks) if m[1] <= ts and (not by or m[0] == u)]
        if before:
            want[e] = max(before)[1]
    assert {r.e: r.name for r in got} == want and len(got) == len(want)


def test_attribution_of_rows_with_maps_in_a_hot_bucket(spark):
    ev = spark.range(500).select(F.timestamp_seconds(F.col("id")).alias("ts"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    mk = spark.createDataFrame([(0, "a"), (250, "b"), (499, "c")], "s bigint, name string").select(F.timestamp_seconds("s").alias("at"), "name")
    got = matching.attribute_to_marks(ev, mk, "ts", "at", "name", blocks=5).collect()
    assert len(got) == 500 and all(r.name == ("a" if r.m["k"] < 250 else "b" if r.m["k"] < 499 else "c") for r in got)


def test_nearest_rank_against_brute_force(spark):
    rng = random.Random(1)
    rows = [("a", rng.randrange(50)) for _ in range(500)] + [("b", rng.randrange(10**6)) for _ in range(301)] + [("c", 7)] + [("d", 1)] * 99 + [("d", 2)]
    got = {r.g: r for r in totals.nearest_rank(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v", logs.LATENCY_POINTS).collect()}
    for g in "abcd":
        values = sorted(v for k, v in rows if k == g)
        for name, p in logs.LATENCY_POINTS.items():
            rank = max(-(-int(round(p * 1000)) * len(values) // 1000), 1)
            assert got[g][name] == values[rank - 1], (g, name)
        assert got[g]["max"] == values[-1] and got[g]["mean"] == pytest.approx(sum(values) / len(values))


@pytest.mark.parametrize("range_values", [1, 3, 40])
def test_ranks_do_not_depend_on_ranges(spark, range_values):
    """Up to 3000 ranges for one group, far more than the sketch has points; heavy values and negative ones too."""
    rng = random.Random(9)
    values = {("g", rng.randrange(-10**6, 10**6)): rng.randrange(1, 4) for _ in range(3000)} | {("h", 5): 1000, ("h", 6): 1}
    counted = spark.createDataFrame([(g, v, n) for (g, v), n in values.items()], "g string, v bigint, n bigint")
    got = {r.g: r for r in totals.nearest_rank_counted(counted, ["g"], "v", "n", {"p50": 0.5, "p99": 0.99}, range_values).collect()}
    for g in "gh":
        whole = sorted(v for (k, v), n in values.items() if k == g for _ in range(n))
        assert [got[g].p50, got[g].p99, got[g]["max"]] == [whole[-(-50 * len(whole) // 100) - 1], whole[-(-99 * len(whole) // 100) - 1], whole[-1]]


def test_callers_are_told_apart_by_their_whole_name(spark):
    rows = [("m", "x" * 30 + c, i) for i, c in enumerate("ab")]
    calls = spark.createDataFrame(rows, "name string, agent string, at bigint")
    assert {r.agent[-1] for r in logs.calls_by_caller(calls, F.lit(0), F.lit(9)).collect()} == {"a", "b"}


def test_late_rows_overlap_and_replay(spark):
    rows = [(1, 0, 0), (2, 0, 30), (3, 0, 100), (4, 0, 55), (5, 0, 20)]
    df = spark.createDataFrame(rows, "k int, v int, s bigint").withColumn("s", F.timestamp_seconds("s"))
    target = df.where("k IN (1, 3)")
    fresh = current.increment(df, target, ["k", "v"], "s")
    # 60 s before the newest row: key 2 (30 s) and key 5 (20 s) are outside and lost, key 4 is inside.
    assert [r.k for r in fresh.collect()] == [4]
    assert current.increment(df, target.unionByName(fresh), ["k", "v"], "s").count() == 0
    assert current.increment(df, df.where("false"), ["k", "v"], "s").count() == 5


def test_latest_with_ties_and_deletes(spark):
    rows = [(1, 5, 0, "a", 0), (1, 5, 1, "b", 0), (2, 1, 0, "x", 0), (2, 2, 0, None, 1), (3, 1, 0, None, 0)]
    df = spark.createDataFrame(rows, "k int, version int, line int, value string, deleted int")
    got = {r.k: r.value for r in current.latest(df, ["k"], ["version", "line"], "deleted").collect()}
    assert got == {1: "b", 3: None}
    ranked = {r.k: r.value for r in current.latest_by_rank(df, ["k"], ["version", "line"]).collect()}
    assert ranked == {1: "b", 2: None, 3: None}


def test_mask_rules(spark):
    rows = [(1, "Ann", "x", 1), (2, None, "y", 1), (3, "é", "z", 1), (4, "Bob", "w", None), (5, "한글", None, 9)]
    df = spark.createDataFrame(rows, "id int, name string, about string, seen int")
    rule = F.col("seen") < 5
    got = {r.id: (r.name, r.about, r.is_masked) for r in masking.mask_rows(df, rule, ["name"], ["about"]).collect()}
    assert got == {1: ("A***", None, True), 2: (None, None, True), 3: ("é***", None, True), 4: ("Bob", "w", False), 5: ("한글", None, False)}
    closed = masking.mask_rows(df, rule, ["name"], ["about"], null_masks=True)
    assert closed.where("id = 4").first().is_masked is True
    assert masking.leak_report(closed, rule, ["name"], ["about"]).first().asDict() == {"rows": 5, "masked": 4, "rule_missed": 0, "leaks": 0}


def test_null_fields_joins_its_rules(spark):
    rows = [
        ("/pay", '{"pin":"12","n":1.50,"deep":[{"pin":[1,{"z":2}]}]}', '{"pin":null,"n":1.50,"deep":[{"pin":null}]}'),
        ("/pay", '{ "n" : 1 }', '{ "n" : 1 }'),
        ("/pay", None, None),
        ("/pay", '{"pin": 5, cut off', None),  # where the value ends is unknown
        ("/pay", "free text about a pin", "free text about a pin"),
        ("/show", '{"pin":"12"}', '{"pin":"12"}'),
    ]
    df = spark.createDataFrame(rows, "endpoint string, raw string, want string")
    rules = spark.createDataFrame([("/pay", "pin"), ("/pay ", "pin"), ("/pay", "cvc"), ("", "n"), ("/show", " ")], "endpoint string, key string")
    got = masking.null_fields(df, "raw", rules)
    assert got.columns == df.columns
    assert [(r.endpoint, r.want) for r in got.collect() if r.raw != r.want] == []


def test_cipher_vectors(spark):
    key, iv = "00112233445566778899aabbccddeeff" * 2, "000102030405060708090a0b0c0d0e0f"
    df = spark.createDataFrame([("hello 한글",), ("",)], "v string")
    k, i = F.unhex(F.lit(key)), F.unhex(F.lit(iv))
    stored = df.select("v", ciphers.encrypt_tagged(F.col("v"), k, i).alias("e"), ciphers.encrypt_versioned(F.col("v"), F.lit("3"), k, i).alias("d"))
    assert all(r.e.startswith("enc:v1:AAECAwQFBgcICQoLDA0OD") and r.d.startswith("3:") for r in stored.collect())
    assert stored.where(ciphers.decrypt_tagged(F.col("e"), k) == F.col("v")).count() == 2
    ring = F.create_map(F.lit("3"), F.struct(k.alias("key"), i.alias("iv")))
    assert stored.where(ciphers.decrypt_versioned(F.col("d"), ring) == F.col("v")).count() == 2
    wrong = F.unhex(F.lit("ff" * 32))
    with pytest.raises(Exception):
        stored.select(ciphers.decrypt_tagged(F.col("e"), wrong)).collect()
    with pytest.raises(Exception, match="unknown key version"):
        stored.select(ciphers.decrypt_versioned(F.lit("9:AAAA"), ring)).collect()
    assert stored.select(ciphers.decrypt_tagged(F.lit("plain"), k).alias("p")).first().p == "plain"


def test_batched_calls_fail_as_they_should(spark):
    df = spark.range(10).withColumnRenamed("id", "k").coalesce(1)
    with pytest.raises(Exception, match="gave 1 rows"):
        keys.call_in_batches(df, ["k"], "r", lambda rows: ["x"], batch_rows=4, pause_seconds=0).collect()

    def refused(rows):
        raise keys.CallRefused("no")

    with pytest.raises(Exception, match="CallRefused"):
        keys.call_in_batches(df, ["k"], "r", refused, pause_seconds=0).collect()
    ok = keys.call_in_batches(df, ["k"], "r", lambda rows: [f"r{k}" for k in rows["k"]], batch_rows=3)
    assert [(r.k, r.r) for r in ok.collect()] == [(i, f"r{i}") for i in range(10)]


def test_unwrap_once_per_key(spark):
    rows = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50 + [("",), (None,)], "edk string")
    table = keys.unwrap_keys(rows, "edk", lambda w: [f"{len(w):02x}" * 32 for _ in w])
    assert table.count() == 2


def test_fills_lookups_and_either_key(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5.0)], "k int, v double")
    assert {r.k: r.v for r in matching.left_join_filled(left, right, ["k"], {"v": 0.0}).collect()} == {1: 5.0, 2: 0.0}
    found = matching.lookup(left, right, ["k"], {"v": F.lit(-1.0)}, flag="known").collect()
    assert {r.k: (r.v, r.known) for r in found} == {1: (5.0, True), 2: (-1.0, False)}
    rows = spark.createDataFrame([("a", "x"), ("y", "a"), ("a", "a"), ("n", None)], "p string, q string")
    ids = spark.createDataFrame([("a",), ("a",)], "id string")
    assert matching.semi_on_either(rows, ["p", "q"], ids, "id").count() == 3


def test_text_helpers(spark):
    sizes = [0, 1023, 1024, 1536, 1075838976, 5 * 1024**4, None]
    got = spark.createDataFrame([(s,) for s in sizes], "n bigint").select(text.readable_bytes(F.col("n")).alias("t")).collect()
    assert [r.t for r in got] == ["0 B", "1023 B", "1.00 KiB", "1.50 KiB", "1.00 GiB", "5.00 TiB", None]
    r = spark.range(1).select(
        text.int_or_zero(F.lit("12x")).alias("a"), text.int_or_zero(F.lit("12")).alias("b"), text.double_or_null(F.lit("z")).alias("c"),
        text.ratio(F.lit(1.0), F.lit(0.0)).alias("d"), text.timestamp_or_null(F.lit("2024/01/02 03:04:05")).cast("string").alias("e"),
    ).first()
    assert tuple(r) == (0, 12, None, None, "2024-01-02 03:04:05")


def test_canonical_values_and_order(spark):
    df = spark.createDataFrame([(1, 1.005, "a  ", None), (2, -0.001, "b", True)], "i int, d double, s string, f boolean")
    one = quality.result_summary(df).first()
    two = quality.result_summary(df.orderBy(F.col("i").desc())).first()
    assert one.result_hash == two.result_hash and list(one.col_sums) == [3.0, 1.0, None, None]
    line = df.select(*[quality.canonical_value(df, c).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in line] == [("1.00", "1.01", "a", "\\N"), ("2.00", "0.00", "b", "true")]


def test_generators_are_deterministic(spark):
    a = generators.game_events(spark, "2026-10-01", 2, 500)
    b = generators.game_events(spark, "2026-10-01", 2, 500).repartition(3)
    assert quality.fingerprint(a).first() == quality.fingerprint(b).first()
    assert a.select("dt").distinct().count() == 2
    whole = quality.fingerprint(generators.clickstream(spark, "2026-10-01", 0, 100)).first()
    halves = generators.clickstream(spark, "2026-10-01", 0, 50).unionByName(generators.clickstream(spark, "2026-10-01", 50, 50))
    assert quality.fingerprint(halves).first() == whole
    u0, u1 = generators.user_properties(spark, 1, 20), generators.user_properties(spark, 1, 20, revision=1)
    assert u0.select(F.size("props")).first()[0] == 40
    changed = u0.alias("a").join(u1.alias("b"), "user_id").select(
        *[F.count_if(F.col("a.props")[k] != F.col("b.props")[k]).alias(k) for k in ("p00", "p01", "p02", "p39")]
    ).first()
    assert changed.p00 == changed.p01 == 20 and changed.p02 == changed.p39 == 0
    mix = {r.event_type: r["count"] for r in generators.game_events(spark, "2026-10-01", 1, 4000).groupBy("event_type").count().collect()}
    assert all(abs(mix[k] / 40 - percent) < 3 for k, percent in generators.EVENT_MIX.items())


def test_adhoc_checks_its_names(spark):
    clicks = generators.clickstream(spark, "2026-10-01", 0, 100)
    with pytest.raises(ValueError):
        serving.adhoc(clicks, "user_id", {}, "2026-10-01", "2026-11-01")
    with pytest.raises(ValueError):
        serving.adhoc(clicks, "country", {"user_id": "1"}, "2026-10-01", "2026-11-01")
    assert serving.adhoc(clicks, "country", {"device": "mobile"}, "2026-10-01", "2026-11-01").count() > 0
