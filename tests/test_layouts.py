"""Layouts that let a reader skip: hash trees, clustering keys, buckets of a keyed table, sorted ciphertexts."""

import glob
import json
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import differences
from tidewell.operators import keys as K
from tidewell.plans import serving
from tidewell.sources import keyed, lake


def test_differences_against_brute_force(spark, folder):
    rng = random.Random(2)
    left = {(i, rng.choice(["a", "b", None])): (rng.randrange(9), rng.choice([None, "x"])) for i in range(4000)}
    left[None, None] = (1, "null key")
    right = dict(left)
    changed = rng.sample(sorted(k for k in left if k[0] is not None), 30)
    want = {}
    for n, k in enumerate(changed):
        if n % 3 == 0:
            del right[k]
            want[k] = ("left", None)
        elif n % 3 == 1:
            right[k] = (left[k][0] + 1, left[k][1])
            want[k] = ("both", ["v"])
        else:
            new = (k[0] + 10_000, k[1])
            right[new] = left[k]
            want[new] = ("right", None)
    schema = "a int, b string, v int, w string"
    frame = lambda rows: spark.createDataFrame([(*k, *v) for k, v in rows.items()], schema).repartition(5)
    for name, rows in (("l", left), ("r", right), ("same", left)):
        differences.store_hashed(frame(rows), f"{folder}/{name}", ["a", "b"])
    found = differences.locate(spark, f"{folder}/l", f"{folder}/r", frame(left).schema, ["a", "b"]).collect()
    assert {(r.a, r.b): (r.found, r["columns"]) for r in found} == want and len(found) == 30
    leaves = differences.differing_leaves(spark, f"{folder}/l", f"{folder}/r")
    assert 0 < len(leaves) <= 30
    assert differences.rows_to_compare(spark, f"{folder}/l", frame(left).schema, leaves).count() < 4001 / 20
    assert differences.differing_leaves(spark, f"{folder}/l", f"{folder}/same") == []
    assert differences.locate(spark, f"{folder}/l", f"{folder}/same", frame(left).schema, ["a", "b"]).count() == 0


def test_clustered_files_are_skipped_by_either_column(spark, folder):
    rng = random.Random(4)
    rows = [(rng.randrange(1000), rng.choice(["kim", "lee", "ann", None]) and f"n{rng.randrange(500):03d}", i) for i in range(6000)] + [(None, None, -1)]
    df = spark.createDataFrame(rows, "a int, b string, id int")
    lake.export_clustered(df, folder + "/z", ["a", "b"], files=32)
    assert sorted(map(str, spark.read.parquet(folder + "/z").collect())) == sorted(map(str, df.collect()))
    groups = []
    for f in glob.glob(folder + "/z/*.parquet"):
        m = pq.ParquetFile(f).metadata
        groups += [[m.row_group(g).column(c).statistics for c in (0, 1)] for g in range(m.num_row_groups)]
    assert len(groups) >= 16
    for c, value in ((0, 500), (1, "n250")):
        met = sum(s[c].has_min_max and s[c].min <= value <= s[c].max for s in groups)
        assert met < len(groups) / 2


def test_clustering_an_empty_or_constant_table(spark, folder):
    df = spark.createDataFrame([(1, None)] * 10, "a int, d date")
    for n, t in enumerate((df, df.limit(0))):
        lake.export_clustered(t, f"{folder}/{n}", ["a", "d"], files=3)
        assert spark.read.schema(df.schema).parquet(f"{folder}/{n}").count() == t.count()


def test_keyed_lines_load_once_and_keep_what_is_broken(spark, folder):
    schema = T.StructType.fromDDL("k int, s string, at int")
    line = lambda *r: json.dumps(dict(zip(("k", "s", "at"), r)))
    batches = {"one": [line(1, "a", 1), line(2, "b", 1), "{broken", line(None, "z", 1)], "two": [line(1, "c", 2), line(3, "d", 1), line(1, "old", 0)]}
    for name in ("one", "two", "one", "two"):
        with open(f"{folder}/{name}.json", "w") as out:
            out.write("\n".join(batches[name]))
        keyed.load_lines(spark, [f"{folder}/{name}.json"], schema, f"{folder}/t", ["k"], name)
    got = keyed.newest(spark, f"{folder}/t", schema, ["k"], ["at"])
    assert sorted(map(tuple, got.collect())) == [(1, "c", 2), (2, "b", 1), (3, "d", 1)]
    rejected = [r.value for r in spark.read.text(f"{folder}/t/rejected/batch=*").collect()]
    assert sorted(rejected) == sorted(["{broken", batches["one"][3]])
    one = keyed.of_key(spark, f"{folder}/t", schema, ["k"], ["at"], [1])
    assert [tuple(r) for r in one.collect()] == [(1, "c", 2)]
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()


def test_stored_ciphertexts_are_found_by_the_scan(spark, folder):
    ring = spark.createDataFrame(
        [("email", str(v), f"{v:064x}", f"{v:032x}") for v in (1, 2)], "column_name string, version string, key_hex string, iv_hex string"
    )
    plain = spark.range(300).select("id", F.concat(F.lit("u"), F.col("id").cast("string")).alias("v"))
    sealed = K.ciphertexts(ring, "email", plain.select("v"), "v").join(plain, "v").where((F.col("id") % 2 + 1).cast("string") == F.col("version"))
    K.store_for_lookup(sealed.select("id", F.col("ciphertext").alias("email")), folder + "/t", "email")
    found = K.find_stored(spark.read.parquet(folder + "/t"), "email", ring, "email", ["u7", "u8", "nobody"])
    assert sorted(r.id for r in found.collect()) == [7, 8]
    assert "PushedFilters: [In(email" in found._jdf.queryExecution().toString()


def test_merged_quantiles_stay_near_the_exact_ones(spark):
    rng = random.Random(6)
    rows = [(i % 120, "x", rng.lognormvariate(3, 1)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "m int, country string, v double").withColumn("ts", F.timestamp_seconds(F.col("m") * 60)).withColumn("event_type", F.lit("e"))
    merged = serving.merge_quantiles(serving.quantile_rollup(df, "v"), ["country"])
    (r,) = serving.quantiles(merged, {"p10": 0.1, "p99": 0.99}).collect()
    values = sorted(v for _, _, v in rows)
    rank = lambda q: sum(v <= q for v in values) / len(values)
    assert r["values"] == 20_000 and abs(rank(r.p10) - 0.1) < 0.02 and abs(rank(r.p99) - 0.99) < 0.02
