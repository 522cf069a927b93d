"""Serving tables and dashboards over a clickstream (ts, user_id, campaign_id, country, device, event_type, revenue)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import epoch_seconds, hour, minute

SKETCH_BITS = 14

# --- rollups -------------------------------------------------------------------------------------------------


def user_stats(events: DataFrame) -> DataFrame:
    """Per user: events, revenue, last time.  Partial rows of several loads may be merged by :func:`merge_user_stats`."""
    return events.groupBy("user_id").agg(
        F.count("*").alias("events"), F.sum("revenue").alias("revenue"), F.max("ts").alias("last_ts")
    )


def merge_user_stats(partials: DataFrame) -> DataFrame:
    return partials.groupBy("user_id").agg(
        F.sum("events").alias("events"), F.sum("revenue").alias("revenue"), F.max("last_ts").alias("last_ts")
    )


def user_totals(stats_or_events: DataFrame, user_id: int) -> DataFrame:
    """One user's totals, from the rollup when it is given one, otherwise from the raw events.

    Write the table sorted by user (``export_sorted(..., bloom=["user_id"])``): the equality then skips row groups.
    """
    one = stats_or_events.where(F.col("user_id") == user_id)
    merged = one if "last_ts" in one.columns else user_stats(one)
    return merged.agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        epoch_seconds(F.max("last_ts")).alias("last_ts"),
    )


def minute_rollup(events: DataFrame, dims: Sequence[str] = ("country", "device", "event_type")) -> DataFrame:
    """Per minute and dimensions: sums, newest time and a mergeable sketch of the users."""
    return events.groupBy(minute(F.col("ts")).alias("minute"), *dims).agg(
        F.count("*").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("users"),
        F.max("ts").alias("newest"),
    )


def remerge(rollup: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Coarser (or complete) rows from partial rollup rows: sums of sums, maximum of maxima, union of sketches."""
    return rollup.groupBy(*keys).agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.hll_union_agg("users").alias("users"),
        F.max("newest").alias("newest"),
    )


def merge_minutes(rollup: DataFrame, dims: Sequence[str] = ("country", "device", "event_type")) -> DataFrame:
    """Partial minute rows of several loads as complete ones."""
    return remerge(rollup, ["minute", *dims])


def hour_rollup(rollup: DataFrame, dims: Sequence[str] = ("country", "device", "event_type")) -> DataFrame:
    return remerge(rollup, [hour(F.col("minute")).alias("hour"), *dims])


#: Size of a quantile sketch; one quantile is off by a rank of about 0.7 % of the rows, with 99 % confidence.
QUANTILE_K, RANK_ERROR = 400, 0.007


def quantile_rollup(events: DataFrame, value: str, dims: Sequence[str] = ("country", "event_type")) -> DataFrame:
    """Per minute and dimensions: rows and a mergeable sketch of the value's distribution."""
    return events.groupBy(minute(F.col("ts")).alias("minute"), *dims).agg(
        F.count(value).alias("values"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_K)).alias("sketch")
    )


def merge_quantiles(rollup: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Coarser rows from partial ones: sketches are merged, the rank error stays that of one sketch."""
    return rollup.groupBy(*keys).agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", F.lit(QUANTILE_K)).alias("sketch"))


def quantiles(merged: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """A column per share, from the sketches."""
    return merged.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in shares.items()}).drop("sketch")


def estimated_users(rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rollup.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


# --- tiles ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tile:
    """A dashboard tile: a time window before ``as_of``, equality filters, one grouping, optional distinct users."""

    name: str
    minutes: int
    group: str | None = None
    where: Mapping[str, str] = field(default_factory=dict)
    users: bool = False


# The twelve tiles.
TILES = (
    Tile("kpi_5m", 5, users=True),
    Tile("kpi_1h", 60, users=True),
    Tile("kpi_24h", 1440, users=True),
    Tile("by_country_1h", 60, "country"),
    Tile("by_device_1h", 60, "device"),
    Tile("by_event_type_1h", 60, "event_type"),
    Tile("by_country_24h", 1440, "country", users=True),
    Tile("per_minute_1h", 60, "minute"),
    Tile("per_hour_24h", 1440, "hour"),
    Tile("purchases_by_country_24h", 1440, "country", {"event_type": "purchase"}),
    Tile("mobile_kpi_1h", 60, where={"device": "mobile"}, users=True),
    Tile("kr_by_event_type_1h", 60, "event_type", {"country": "KR"}),
)


def _tile_key(tile: Tile, at: Column) -> Column:
    if tile.group is None:
        return F.lit("")
    if tile.group == "minute":
        return F.date_format(minute(at), "yyyy-MM-dd HH:mm:ss")
    if tile.group == "hour":
        return F.date_format(hour(at), "yyyy-MM-dd HH:mm:ss")
    return F.col(tile.group)


def _membership(df: DataFrame, tiles: Sequence[Tile], at: Column, starts: Mapping[int, Column]) -> DataFrame:
    """One row per (row, tile it belongs to); the widest window is applied before, where it can reach the scan."""
    cells = []
    for tile in tiles:
        inside = at >= starts[tile.minutes]
        for column, value in tile.where.items():
            inside = inside & (F.col(column) == value)
        cells.append(
            F.when(
                inside,
                F.struct(F.lit(tile.name).alias("tile"), _tile_key(tile, at).alias("key"), F.lit(tile.users).alias("count_users")),
            )
        )
    widest = starts[max(t.minutes for t in tiles)]
    joined = df.where(at >= widest).withColumn("_t", F.explode(F.array(*cells)))
    return joined.where(F.col("_t").isNotNull()).select("*", "_t.*").drop("_t")


def _starts(tiles: Sequence[Tile], as_of: Column, aligned: bool) -> dict[int, Column]:
    start = {m: as_of - F.expr(f"INTERVAL {m} MINUTES") for m in {t.minutes for t in tiles}}
    return {m: minute(c) if aligned else c for m, c in start.items()}


def tiles_from_events(events: DataFrame, as_of: Column, tiles: Sequence[Tile] = TILES) -> DataFrame:
    """All tiles from the raw events in one scan and one pass of aggregation.

    A row joins every tile it belongs to, then rows are reduced by (tile, key, user) before anything is
    brought together, so the one-row tiles that hold every event are spread like the others.
    """
    member = _membership(events, tiles, F.col("ts"), _starts(tiles, as_of, aligned=False))
    by_user = member.groupBy("tile", "key", "count_users", "user_id").agg(
        F.count("*").alias("events"), F.sum("revenue").alias("revenue"), F.max("ts").alias("newest")
    )
    return by_user.groupBy("tile", "key").agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(F.col("count_users") & F.col("user_id").isNotNull(), 1)).alias("users"),
        epoch_seconds(F.max("newest")).alias("newest"),
    )


def tiles_from_rollup(rollup: DataFrame, as_of: Column, tiles: Sequence[Tile] = TILES) -> DataFrame:
    """The same tiles from the minute rollup; windows start on the minute, users are estimates of the sketches."""
    member = _membership(rollup, tiles, F.col("minute"), _starts(tiles, as_of, aligned=True))
    return member.groupBy("tile", "key").agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.when(
            F.max("count_users"), F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("count_users"), F.col("users"))))
        ).alias("users"),
        epoch_seconds(F.max("newest")).alias("newest"),
    )


def tile(events: DataFrame, name: str, as_of: Column) -> DataFrame:
    """One tile on its own."""
    chosen = [t for t in TILES if t.name == name]
    if not chosen:
        raise ValueError(f"unknown tile {name!r}")
    return tiles_from_events(events, as_of, chosen)


# --- ad-hoc aggregation ----------------------------------------------------------------------------------------

DIMENSIONS = ("campaign_id", "country", "device", "event_type", "hour")
FILTERS = ("country", "device", "event_type")


def adhoc(
    events: DataFrame, dimension: str, filters: Mapping[str, str], start: str, end: str, count: int = 100, exact: bool = False
) -> DataFrame:
    """Top groups of one dimension within a half-open time range, with up to three equality filters.

    Names are checked against the known ones; values never become part of a query text.
    """
    if dimension not in DIMENSIONS:
        raise ValueError(f"dimension must be one of {DIMENSIONS}")
    if unknown := set(filters) - set(FILTERS):
        raise ValueError(f"unknown filters {sorted(unknown)}")
    kind = events.schema["ts"].dataType
    df = events.where((F.col("ts") >= F.lit(start).cast(kind)) & (F.col("ts") < F.lit(end).cast(kind)))
    for column, value in filters.items():
        df = df.where(F.col(column) == value)
    key = F.date_format(hour(F.col("ts")), "yyyy-MM-dd HH:mm:ss") if dimension == "hour" else F.col(dimension).cast("string")
    if exact:
        by_user = df.groupBy(key.alias("k"), "user_id").agg(F.count("*").alias("_c"), F.sum("revenue").alias("_r"))
        grouped = by_user.groupBy("k").agg(F.sum("_c").alias("c"), F.sum("_r").alias("r"), F.count("user_id").alias("u"))
    else:
        grouped = df.groupBy(key.alias("k")).agg(
            F.count("*").alias("c"), F.sum("revenue").alias("r"), F.approx_count_distinct("user_id").alias("u")
        )
    return grouped.orderBy(F.col("c").desc(), "k").limit(count)
