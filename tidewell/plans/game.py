"""Game-log jobs: items out of JSON payloads, and the five BI questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import hour
from tidewell.operators.totals import distinct_per_group
from tidewell.sources.generators import ITEM_EVENTS

ITEMS = "items ARRAY<STRUCT<item_id: INT, qty: INT, price: INT>>"


def explode_items(
    events: DataFrame,
    payload: str = "payload",
    keep: Sequence[str] = ("event_id", "event_time", "player_id", "server_id", "platform", "event_type", "dt"),
    kinds: Sequence[str] | None = ITEM_EVENTS,
    items: str = ITEMS,
) -> DataFrame:
    """One row per element of ``payload.items``; events with no, empty or unreadable items give none.

    Narrow: no shuffle, the event filter reaches the scan, and a huge array only makes its own task longer.
    """
    df = events if kinds is None else events.where(F.col("event_type").isin(*kinds))
    # Outer with position, then a filter on the position: from an inner explode the optimizer infers a filter on the
    # array, which would parse every payload twice.
    parsed = df.select(*keep, F.posexplode_outer(F.from_json(payload, items)["items"]).alias("_at", "_item"))
    return parsed.where(F.col("_at").isNotNull()).select(*keep, "_item.*")


def revenue(qty: str = "qty", price: str = "price") -> Column:
    """qty x price, widened before the product so that it cannot overflow."""
    return F.sum(F.col(qty).cast("bigint") * F.col(price))


def within_days(events: DataFrame, first_day: str, last_day: str, at: str = "event_time") -> DataFrame:
    """Events of the days from first to last. The day column prunes partitions; the half-open range of the time says the
    same for row groups of tables that are not partitioned, or whose day is derived."""
    first, after = F.to_timestamp_ntz(F.lit(first_day)), F.to_timestamp_ntz(F.lit(last_day)) + F.expr("INTERVAL 1 DAY")
    kind = events.schema[at].dataType.simpleString()
    return events.where(F.col("dt").between(first_day, last_day) & (F.col(at) >= first.cast(kind)) & (F.col(at) < after.cast(kind)))


def daily_users(events: DataFrame, first_day: str, last_day: str, by: str = "platform", user: str = "player_id") -> DataFrame:
    """Exact distinct users by day and one dimension."""
    days = within_days(events, first_day, last_day)
    return distinct_per_group(days, ["dt", by], user, "dau").orderBy("dt", by)


def top_items(items: DataFrame, kind: str = "purchase", count: int = 10) -> DataFrame:
    return (
        items.where(F.col("event_type") == kind)
        .groupBy("item_id")
        .agg(revenue().alias("revenue"), F.count("*").alias("n"))
        .orderBy(F.col("revenue").desc(), "item_id")
        .limit(count)
    )


def day_by_server(events: DataFrame, day: str, count: int = 20) -> DataFrame:
    return (
        within_days(events, day, day)
        .groupBy("event_type", "server_id")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "event_type", "server_id")
        .limit(count)
    )


def top_spenders(items: DataFrame, kinds: Sequence[str] = ("purchase", "gacha"), count: int = 20) -> DataFrame:
    return (
        items.where(F.col("event_type").isin(*kinds))
        .groupBy("player_id")
        .agg(revenue().alias("spend"))
        .orderBy(F.col("spend").desc(), "player_id")
        .limit(count)
    )


def hourly_count(events: DataFrame, first_day: str, last_day: str, kind: str = "login") -> DataFrame:
    chosen = within_days(events, first_day, last_day).where(F.col("event_type") == kind)
    return chosen.groupBy(hour(F.col("event_time")).alias("h")).agg(F.count("*").alias("n")).orderBy("h")
