"""python tests/check_queries.py [sf_dir] [name-part ...]: compare the chosen queries with their SQL twins."""

import os
import sys
import time
import traceback

here = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [here, os.path.dirname(here)]

import oracle  # noqa: E402
import __spark_entry__ as entry  # noqa: E402


def main():
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle.connect(sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            res = oracle.compare(df, con, sqls[name]) if name in sqls else f"rows only {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            res = "FAILED " + (str(e)[:700] if "-v" not in wanted else traceback.format_exc())
        bad += not res.startswith(("ok", "rows only"))
        print(f"{name:28s} {time.time() - t0:6.1f}s  {res}", flush=True)
    print("not right:", bad)


main()
