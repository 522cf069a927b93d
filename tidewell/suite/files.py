"""Files and catalog: round trips, exports, loads with reconciliation, store export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import text
from tidewell.functions.checks import require
from tidewell.sources import catalog, export, files, lake
from tidewell.suite.base import cents, query, table
from tidewell.workspace import scratch

_ROWS = "id BIGINT, name STRING, value BIGINT, note STRING"


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with text that needs quoting: separators, quotes, tabs, line ends, backslashes, empty text, NULL."""
    k = F.col("o_orderkey")
    note = (
        F.when(k % 8 == 0, F.lit('a,"b"'))
        .when(k % 8 == 1, F.lit("tab\there"))
        .when(k % 8 == 2, F.lit("back\\nslash"))
        .when(k % 8 == 3, F.lit("한글"))
        .when(k % 8 == 4, F.lit("\\N"))
        .when(k % 8 == 5, F.lit(""))
        .when(k % 8 == 6, F.lit("two\nlines\r"))
    )
    return table(spark, sf, "orders").select(
        k.alias("id"), F.col("o_orderpriority").alias("name"), cents(F.col("o_totalprice")).alias("value"), note.alias("note")
    )


_ROUND_SQL = """SELECT o_orderpriority AS name, CASE o_orderkey % 8 WHEN 0 THEN 'a,"b"' WHEN 1 THEN 'tab' || chr(9) || 'here' WHEN 2 THEN 'back\\nslash'
   WHEN 3 THEN '한글' WHEN 4 THEN '\\N' WHEN 5 THEN '' WHEN 6 THEN 'two' || chr(10) || 'lines' || chr(13) END AS note, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total FROM orders GROUP BY 1, 2"""


def _grouped(df: DataFrame) -> DataFrame:
    return df.groupBy("name", "note").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("io_roundtrip_csv", _ROUND_SQL)
def io_roundtrip_csv(spark, sf):
    """Two CSV folders read by one glob, aggregated, exported and read back."""
    root, rows = scratch(spark, "csv"), _rows(spark, sf)
    files.write_csv(rows.where("id % 2 = 0"), f"{root}/part=even")
    files.write_csv(rows.where("id % 2 = 1"), f"{root}/part=odd")
    read = files.read_csv(spark, f"{root}/part=*", _ROWS, "*.csv")
    return files.export(_grouped(read), f"{root}/out", "csv")


@query("io_roundtrip_tsv", _ROUND_SQL)
def io_roundtrip_tsv(spark, sf):
    root = scratch(spark, "tsv")
    files.write_tsv(_rows(spark, sf), f"{root}/in")
    return files.export(_grouped(files.read_tsv(spark, f"{root}/in", _ROWS)), f"{root}/out", "tsv")


@query("io_roundtrip_json", _ROUND_SQL)
def io_roundtrip_json(spark, sf):
    """JSON lines, one set of files per value of a column, read back as one table."""
    root = scratch(spark, "json")
    files.write_json_lines(_rows(spark, sf).withColumn("bucket", F.col("id") % 3), f"{root}/in", ["bucket"])
    return files.export(_grouped(files.read_json_lines(spark, f"{root}/in/bucket=*", _ROWS)), f"{root}/out", "json")


@query("io_roundtrip_parquet", _ROUND_SQL.replace("sum(CAST(round", "sum(2 * CAST(round"))
def io_roundtrip_parquet(spark, sf):
    """Written with a derived value and a processing time, aggregated, exported."""
    root = scratch(spark, "parquet")
    files.write_processed(_rows(spark, sf), f"{root}/in", "value")
    read = spark.read.parquet(f"{root}/in").where(F.col("processed_at") <= F.current_timestamp())
    return files.export(_grouped(read), f"{root}/out", "parquet")


@query("io_roundtrip_orc", _ROUND_SQL)
def io_roundtrip_orc(spark, sf):
    root = scratch(spark, "orc")
    return files.export(_grouped(files.export(_rows(spark, sf), f"{root}/in", "orc")), f"{root}/out", "orc")


@query(
    "io_summary",
    """SELECT count(*) AS total_rows, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_value, min(o_orderdate) AS min_time, max(o_orderdate) AS max_time FROM orders""",
)
def io_summary(spark, sf):
    return table(spark, sf, "orders").agg(
        F.count("*").alias("total_rows"), F.sum(cents(F.col("o_totalprice"))).alias("total_value"),
        F.min("o_orderdate").alias("min_time"), F.max("o_orderdate").alias("max_time"),
    )


@query(
    "io_good_and_bad_lines",
    """SELECT 'good' AS kind, count(*) AS rows FROM events WHERE event_id % 8 <> 0 UNION ALL SELECT 'bad', count(*) FROM events WHERE event_id % 8 = 0""",
)
def io_good_and_bad_lines(spark, sf):
    """Broken lines go to a quarantine and stop nothing."""
    path = scratch(spark, "lines")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.when(F.col("event_id") % 8 == 0, F.substring(line, 1, 20)).otherwise(line)
    table(spark, sf, "events").select(broken.alias("value")).write.text(path)
    schema = T._parse_datatype_string("event_id BIGINT, user_id BIGINT, event_type STRING")
    good, bad = files.split_good_and_bad(spark, path, schema)
    count = lambda df, kind: df.agg(F.count("*").alias("rows")).withColumn("kind", F.lit(kind))
    return count(good, "good").unionByName(count(bad, "bad"))


@query(
    "io_daily_export",
    """SELECT CAST(ts AS DATE) AS activity_date, count(DISTINCT user_id) AS total_users, count(*) AS total_actions FROM events GROUP BY 1""",
)
def io_daily_export(spark, sf):
    e = table(spark, sf, "events").withColumn("activity_date", F.to_date("ts"))
    by_user = e.groupBy("activity_date", "user_id").agg(F.count("*").alias("n"))
    daily = by_user.groupBy("activity_date").agg(F.count("user_id").alias("total_users"), F.sum("n").alias("total_actions"))
    return files.export(daily, scratch(spark, "daily"), "parquet", files=1)


@query(
    "io_sorted_export",
    """SELECT l_returnflag, count(*) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-04-01' GROUP BY 1""",
)
def io_sorted_export(spark, sf):
    """The fact table exported in date order, so a date range skips most row groups."""
    path = scratch(spark, "sorted")
    lake.export_sorted(table(spark, sf, "lineitem"), path, "l_shipdate", rows_per_file=200_000)
    day = lambda t: F.lit(t).cast("timestamp_ntz")
    q1 = spark.read.parquet(path).where((F.col("l_shipdate") >= day("1998-01-01")) & (F.col("l_shipdate") < day("1998-04-01")))
    return q1.groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query(
    "io_describe",
    """SELECT column_name AS "column", CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' END AS type
       FROM (DESCRIBE SELECT * FROM customer)""",
)
def io_describe(spark, sf):
    return lake.describe(table(spark, sf, "customer")).select("column", "type")


_ALL = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


@query(
    "catalog_load_all",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM {t}) AS expected_rows, 'ok' AS status"""
        for t in _ALL
    ),
)
def catalog_load_all(spark, sf):
    """All tables loaded, with row counts compared."""
    tables = {t: table(spark, sf, t) for t in _ALL}
    return catalog.load_and_reconcile(tables, scratch(spark, "load"))


@query(
    "catalog_adapt_schema",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(15,2))::DOUBLE AS c_acctbal FROM customer""",
)
def catalog_adapt_schema(spark, sf):
    """Columns cast to a target schema; those it does not name are left out."""
    target = T._parse_datatype_string("c_custkey STRING, c_name STRING, c_acctbal DECIMAL(15,2)")
    adapted = catalog.adapt_schema(table(spark, sf, "customer"), target)
    return adapted.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query(
    "catalog_category_revenue",
    """SELECT p_brand AS category, CAST(sum(CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS revenue
       FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def catalog_category_revenue(spark, sf):
    """A query with named parameters over views given by identifier; the names are this run's own."""
    own = scratch(spark, "v").rsplit("-", 1)[-1]
    table(spark, sf, "lineitem").createOrReplaceTempView(f"tw_fact_{own}")
    table(spark, sf, "part").createOrReplaceTempView(f"tw_part_{own}")
    return catalog.with_parameters(
        spark,
        """SELECT p_brand AS category, sum(CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * :scale) AS BIGINT)) AS revenue
           FROM IDENTIFIER(:fact) JOIN IDENTIFIER(:part) ON p_partkey = l_partkey GROUP BY p_brand""",
        fact=f"tw_fact_{own}",
        part=f"tw_part_{own}",
        scale=100,
    )


@query(
    "catalog_external",
    """SELECT o_orderpriority AS priority, count(*) AS rows, TRUE AS listed FROM orders GROUP BY 1""",
)
def catalog_external(spark, sf):
    """A named table over files that stay where they are, found in the catalog's list."""
    path = scratch(spark, "external")
    table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").write.parquet(path)
    name = "tw_ext_" + path.rsplit("-", 1)[-1]
    found = catalog.external_table(spark, name, path, "parquet")
    listed = catalog.list_tables(spark).where((F.col("table") == name) & ~F.col("temporary")).count() == 1
    return found.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("rows"), F.lit(listed).alias("listed"))


@query(
    "catalog_create_as",
    """SELECT 'large' AS "table", count(*) AS rows, count(*) AS expected_rows, 'ok' AS status FROM orders WHERE o_totalprice > 100000""",
)
def catalog_create_as(spark, sf):
    """A table created from a query, reconciled with it."""
    name = "tw_ctas_" + scratch(spark, "c").rsplit("-", 1)[-1]
    result = catalog.create_as(spark, name, table(spark, sf, "orders").where("o_totalprice > 100000"))
    return result.withColumn("table", F.lit("large"))


@query(
    "catalog_partitioned_append",
    """SELECT o_orderstatus AS status, CAST(2 * count(*) AS BIGINT) AS rows, CAST(2 * sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total
       FROM orders GROUP BY 1""",
)
def catalog_partitioned_append(spark, sf):
    """Two appends to a table partitioned by a value."""
    name = "tw_sales_" + scratch(spark, "p").rsplit("-", 1)[-1]
    sales = table(spark, sf, "orders").select("o_orderkey", cents(F.col("o_totalprice")).alias("c"), F.col("o_orderstatus").alias("status"))
    for _ in range(2):
        catalog.append_partitioned(sales, name, "status")
    return spark.table(name).groupBy("status").agg(F.count("*").alias("rows"), F.sum("c").alias("total"))


@query(
    "text_casts",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey ELSE 0 END AS whole, CASE WHEN o_orderkey % 4 < 2 THEN o_custkey / 2 END AS number,
              CASE WHEN o_orderkey % 5 < 4 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL (o_orderkey % 1440) MINUTE END AS at FROM orders""",
)
def text_casts(spark, sf):
    """Casts of text with a fallback: whole numbers, numbers and times in several shapes, and text that is none of them."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    at = F.col("o_orderdate").cast("date").cast("timestamp") + F.make_dt_interval(mins=(key % 1440).cast("int"))
    number = (
        F.when(key % 4 == 0, cust.cast("string")).when(key % 4 == 1, (cust / 2).cast("string")).when(key % 4 == 2, F.concat(cust.cast("string"), F.lit("x"))).otherwise("")
    )
    halved = F.when(key % 4 == 0, (cust / 2).cast("string")).otherwise(number)
    time = (
        F.when(key % 5 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).when(key % 5 == 1, F.date_format(at, "yyyy/MM/dd HH:mm:ss"))
        .when(key % 5 == 2, F.date_format(at, "dd.MM.yyyy HH:mm")).when(key % 5 == 3, F.date_format(at, "yyyyMMddHHmmss")).otherwise("soon")
    )
    rows = table(spark, sf, "orders").select("o_orderkey", number.alias("n"), halved.alias("d"), time.alias("t"))
    return rows.select(
        "o_orderkey", text.int_or_zero(F.col("n")).alias("whole"), text.double_or_null(F.col("d")).alias("number"),
        text.timestamp_or_null(F.col("t")).cast("timestamp_ntz").alias("at"),
    )


@query("text_required", "SELECT count(*) AS orders, TRUE AS checked FROM orders")
def text_required(spark, sf):
    """A result that fails the query unless what it must satisfy holds: no order has a negative price."""
    whole = table(spark, sf, "orders").agg(F.count("*").alias("orders"), F.min("o_totalprice").alias("least"))
    return whole.select("orders", require(F.coalesce(F.col("least"), F.lit(0.0)) >= 0, "an order has a negative price").alias("checked"))


@query(
    "store_export",
    "SELECT count(DISTINCT user_id) AS rows, TRUE AS resent FROM events",
)
def store_export(spark, sf):
    """User totals sent to a store that leaves the last row of every new batch unprocessed once."""

    def open_store():
        seen = set()

        def put(rows):
            last = rows[-1]["user_id"]
            if last in seen:
                return []
            seen.add(last)
            return rows[-1:]

        return put

    stats = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("events"))
    sent = export.export_rows(stats, open_store, batch_rows=25, pause_seconds=0.001)
    return sent.select("rows", (F.col("retries") == F.col("batches")).alias("resent"))


@query(
    "io_clustered_export",
    """SELECT 'part' AS filter, count(*) AS rows, TRUE AS under_half FROM lineitem WHERE l_partkey BETWEEN (SELECT max(l_partkey) // 2 FROM lineitem)
         AND (SELECT max(l_partkey) // 2 + max(l_partkey) // 100 FROM lineitem) UNION ALL
       SELECT 'day', count(*), TRUE FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-06-01' AND DATE '1995-06-20'""",
)
def io_clustered_export(spark, sf):
    """Line items clustered by part and day: a narrow filter on either column can meet under half of the files."""
    path = scratch(spark, "clustered")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_quantity")
    lake.export_clustered(lines, path, ["l_partkey", "l_shipdate"], files=64)
    held = spark.read.schema(lines.schema).parquet(path)
    top = held.agg(F.max("l_partkey").alias("m")).scalar()
    first, last = F.floor(top / 2), F.floor(top / 2) + F.floor(top / 100)
    day = [F.lit(d).cast("date") for d in ("1995-06-01", "1995-06-20")]
    spans = held.groupBy(F.col("_metadata.file_path").alias("f")).agg(*[f(c).alias(f"{n}_{c}") for c in ("l_partkey", "l_shipdate") for n, f in (("lo", F.min), ("hi", F.max))])
    out = None
    for name, column, lo, hi in (("part", "l_partkey", first, last), ("day", "l_shipdate", *day)):
        met = spans.agg((F.count_if((F.col(f"lo_{column}") <= hi) & (F.col(f"hi_{column}") >= lo)) * 2 < F.count("*")).alias("under_half"))
        counted = held.where(F.col(column).between(lo, hi)).agg(F.count("*").alias("rows")).withColumn("under_half", met.scalar())
        row = counted.withColumn("filter", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out
