"""Registration of queries and the views of the given tables that stand in for the workloads' own inputs.

Amounts are carried as whole cents wherever sums are compared: integer sums do not depend on the order
the tasks finish in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.generators import COUNTRIES, DEVICES

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


# --- clickstream from events -----------------------------------------------------------------------------


def clickstream(spark: SparkSession, sf: str) -> DataFrame:
    user = F.col("user_id")
    return table(spark, sf, "events").select(
        "ts",
        "user_id",
        F.pmod("event_id", F.lit(1000)).alias("campaign_id"),
        pick(COUNTRIES, user % len(COUNTRIES)).alias("country"),
        pick(DEVICES, user % len(DEVICES)).alias("device"),
        "event_type",
        cents(F.col("value")).alias("revenue"),
    )


CLICKSTREAM_SQL = f"""clicks AS (
  SELECT ts, user_id, event_id % 1000 AS campaign_id,
         {sql_list(COUNTRIES)}[CAST(user_id % {len(COUNTRIES)} AS INTEGER) + 1] AS country,
         {sql_list(DEVICES)}[CAST(user_id % {len(DEVICES)} AS INTEGER) + 1] AS device,
         event_type, CAST(round(value * 100) AS BIGINT) AS revenue
  FROM events)"""


# --- game events from lineitem and orders ------------------------------------------------------------------

_KINDS = ("purchase", "gacha", "item_drop", "login", "logout")
_PLATFORM = {"A": "android", "N": "ios"}


def game_events(spark: SparkSession, sf: str, players: bool = True) -> DataFrame:
    """One event per line item; purchases, draws and drops carry 0 to 3 items in their payload. Without ``players`` the
    orders are not read and player_id is NULL, for questions that do not ask who."""
    lines = table(spark, sf, "lineitem")
    if players:
        orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("player_id"))
        lines = lines.join(orders, "l_orderkey")
    else:
        lines = lines.withColumn("player_id", F.lit(None).cast("bigint"))
    quantity = F.col("l_quantity").cast("int")
    kind = pick(_KINDS, F.col("l_linenumber") % len(_KINDS))
    price = (
        F.when(F.col("event_type") == "purchase", ((F.col("l_suppkey") % 20 + 1) * 250).cast("int"))
        .when(F.col("event_type") == "gacha", 90)
        .otherwise(0)
    )
    items = F.transform(
        F.when(quantity % 4 > 0, F.sequence(F.lit(1), quantity % 4)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            ((F.col("l_partkey") * 7 + i) % 5000 + 1).cast("int").alias("item_id"),
            ((quantity + i) % 5 + 1).cast("int").alias("qty"),
            price.alias("price"),
        ),
    )
    payload = F.when(
        F.col("event_type").isin("purchase", "gacha", "item_drop"),
        F.to_json(F.struct(F.lit("KRW").alias("currency"), items.alias("items"))),
    ).otherwise(F.to_json(F.struct(quantity.alias("duration_s"))))
    return lines.withColumn("event_type", kind).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
        F.col("l_shipdate").alias("event_time"),
        "player_id",
        (F.col("l_suppkey") % 64 + 1).cast("int").alias("server_id"),
        F.when(F.col("l_returnflag") == "A", "android").when(F.col("l_returnflag") == "N", "ios").otherwise("pc").alias("platform"),
        "event_type",
        payload.alias("payload"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"),
    )


GAME_SQL = """game AS (
  SELECT l_orderkey * 10 + l_linenumber AS event_id, l_shipdate AS event_time, o_custkey AS player_id,
         CAST(l_suppkey % 64 + 1 AS INTEGER) AS server_id,
         CASE l_returnflag WHEN 'A' THEN 'android' WHEN 'N' THEN 'ios' ELSE 'pc' END AS platform,
         ['purchase','gacha','item_drop','login','logout'][l_linenumber % 5 + 1] AS event_type,
         CAST(l_quantity AS INTEGER) AS q, l_partkey AS part, l_suppkey AS supp,
         strftime(l_shipdate, '%Y-%m-%d') AS dt
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
items AS (
  SELECT event_id, player_id, server_id, platform, event_type, dt,
         CAST((part * 7 + i) % 5000 + 1 AS INTEGER) AS item_id,
         CAST((q + i) % 5 + 1 AS INTEGER) AS qty,
         CAST(CASE event_type WHEN 'purchase' THEN (supp % 20 + 1) * 250 WHEN 'gacha' THEN 90 ELSE 0 END AS INTEGER) AS price
  FROM (SELECT *, unnest(range(1, q % 4 + 1)) AS i FROM game WHERE event_type IN ('purchase','gacha','item_drop')))"""
