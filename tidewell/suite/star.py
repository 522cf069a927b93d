"""Star-schema query shapes as Spark SQL: subqueries, set operations, groupings, ranks, shares."""

from __future__ import annotations

from tidewell.suite.base import query, table

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
_CENTS = "CAST(round({c} * 100) AS BIGINT)"


def _star(name: str, sql: str, oracle: str | None = None) -> None:
    """Register one text for both engines; ``oracle`` only where the dialects differ."""

    def run(spark, sf):
        for t in _TABLES:
            table(spark, sf, t).createOrReplaceTempView(t)
        return spark.sql(sql)

    run.__name__ = name
    query(name, oracle or sql)(run)


_PRICE = _CENTS.format(c="l_extendedprice")
_TOTAL = _CENTS.format(c="o_totalprice")

_star(
    "star_three_way_join",
    f"""SELECT r_name, n_name, CAST(sum({_TOTAL}) AS BIGINT) AS total, count(*) AS orders
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        GROUP BY r_name, n_name""",
)
_star(
    "star_pricing_summary",
    f"""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty, CAST(sum({_PRICE}) AS BIGINT) AS sum_base,
               round(avg(l_quantity), 6) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-06-01' GROUP BY l_returnflag, l_linestatus""",
)
# More than 1.2 times the average of its own group: a correlated scalar subquery.
_star(
    "star_correlated_average",
    f"""SELECT o_orderkey, {_TOTAL} AS cents FROM orders o
        WHERE {_TOTAL} > (SELECT 1.2 * avg(CAST({_CENTS.format(c="i.o_totalprice")} AS DOUBLE)) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
_star(
    "star_excess_discount",
    f"""SELECT p_brand, CAST(sum({_PRICE}) AS BIGINT) AS excess FROM lineitem JOIN part ON p_partkey = l_partkey
        WHERE l_discount > (SELECT 1.3 * avg(i.l_discount) + 0.0001 FROM lineitem i WHERE i.l_partkey = p_partkey) GROUP BY p_brand""",
)
_star(
    "star_exists",
    """SELECT c_mktsegment, count(*) AS customers FROM customer
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
         AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2001-01-01')
       GROUP BY c_mktsegment""",
)
_star(
    "star_rollup",
    f"""SELECT n_name, c_mktsegment, grouping(n_name) + grouping(c_mktsegment) AS level, CAST(sum({_TOTAL}) AS BIGINT) AS total
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP (n_name, c_mktsegment)""",
)
_star(
    "star_cube",
    """SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g1, grouping(l_linestatus) AS g2, count(*) AS n
       FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
_star(
    "star_grouping_sets",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""",
)
_star(
    "star_rank",
    f"""SELECT n_name, c_custkey, total, place FROM (
          SELECT n_name, c_custkey, total, rank() OVER (PARTITION BY n_name ORDER BY total DESC) AS place FROM (
            SELECT n_name, c_custkey, CAST(sum({_TOTAL}) AS BIGINT) AS total FROM orders JOIN customer ON c_custkey = o_custkey
            JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name, c_custkey) s) r WHERE place <= 3""",
)
_star(
    "star_intersect",
    """SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000""",
)
_star(
    "star_except",
    """SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45""",
)
_star(
    "star_union_all",
    """SELECT 'customer' AS kind, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY c_nationkey
       UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY s_nationkey""",
)
_star(
    "star_share_of_nation",
    f"""SELECT n_name, c_mktsegment, total, round(100.0 * total / sum(total) OVER (PARTITION BY n_name), 4) AS share_pct FROM (
          SELECT n_name, c_mktsegment, CAST(sum({_TOTAL}) AS DOUBLE) AS total FROM orders JOIN customer ON c_custkey = o_custkey
          JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name, c_mktsegment) s""",
)
_star(
    "star_moving_sum",
    f"""SELECT m, total, CAST(sum(total) OVER (ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS three_months FROM (
          SELECT year(o_orderdate) * 100 + month(o_orderdate) AS m, CAST(sum({_TOTAL}) AS BIGINT) AS total FROM orders
          GROUP BY year(o_orderdate) * 100 + month(o_orderdate)) s""",
)
_star(
    "star_case_pivot",
    """SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o,
              count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS p FROM orders GROUP BY o_orderpriority""",
)
_star(
    "star_having",
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(*) AS n FROM lineitem GROUP BY l_suppkey
       HAVING count(DISTINCT l_partkey) > (SELECT count(*) / (4 * (SELECT count(*) FROM supplier)) FROM lineitem)""",
)
