"""Sessions and sliding windows from parts that can be merged, however late a row comes.

Rows are first added up in panes: slots of the session gap for sessions (two rows of one slot are less than a gap apart,
so a slot is never torn), slots of the slide for sliding windows. Panes are combined before the shuffle, so a user with
a third of all rows is a few rows per slot. Parts of several batches are merged by the same rule, also in the levels of
:mod:`tidewell.streaming.levels`: there is no watermark, no row is too late, and no state beyond the parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.streaming import levels


def _slot(at: Column, seconds: int) -> Column:
    micros = F.unix_micros(at.cast("timestamp"))
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("bigint")


def _micros(at: str) -> Column:
    return F.unix_micros(F.col(at).cast("timestamp"))


# --- sessions -------------------------------------------------------------------------------------------------


def session_parts(rows: DataFrame, at: str, gap_seconds: int, by: Sequence[str], value: str) -> DataFrame:
    """Sessions of these rows alone: ``by``, started_at, last_at, events, total."""
    panes = rows.groupBy(*by, _slot(F.col(at), gap_seconds).alias("_slot")).agg(
        F.min(at).alias("started_at"), F.max(at).alias("last_at"), F.count("*").alias("events"), F.sum(value).alias("total")
    )
    return merge_sessions(panes.drop("_slot"), gap_seconds, by)


def merge_sessions(parts: DataFrame, gap_seconds: int, by: Sequence[str]) -> DataFrame:
    """Sessions from parts: two belong together when the later starts at most a gap after the other's last row.

    A key's parts are sorted in one task; there are at most as many as gaps in the time span, for each part table.
    """
    order = Window.partitionBy(*by).orderBy("started_at", "last_at")
    reached = F.max("last_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.withColumn("_reached", reached)
    opens = F.coalesce(_micros("started_at") - _micros("_reached") > gap_seconds * 1_000_000, F.lit(True))
    numbered = marked.withColumn("_session", F.sum(opens.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_session").agg(
        F.min("started_at").alias("started_at"), F.max("last_at").alias("last_at"), F.sum("events").alias("events"), F.sum("total").alias("total")
    ).drop("_session")


def sessions(stream: DataFrame, at: str, gap_seconds: int, by: Sequence[str], value: str, path: str, fan_out: int = levels.FAN_OUT):
    """Follow a stream: each batch's sessions become a part, parts are merged by levels."""
    merge = lambda parts: merge_sessions(parts, gap_seconds, by)
    return stream.writeStream.foreachBatch(lambda b, n: levels.add(session_parts(b, at, gap_seconds, by, value), n, path, merge, fan_out))


# --- sliding windows --------------------------------------------------------------------------------------------


def pane_parts(rows: DataFrame, at: str, slide_seconds: int, by: Sequence[str], value: str) -> DataFrame:
    """``by``, pane (its number since 1970), events, total."""
    return rows.groupBy(*by, _slot(F.col(at), slide_seconds).alias("pane")).agg(F.count("*").alias("events"), F.sum(value).alias("total"))


def merge_panes(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by, "pane").agg(F.sum("events").alias("events"), F.sum("total").alias("total"))


def sliding_windows(panes: DataFrame, slide_seconds: int, width_panes: int, by: Sequence[str]) -> DataFrame:
    """Every window of ``width_panes`` panes that has a row: ``by``, window_start, events, total.

    A pane belongs to as many windows as a window has panes; rows never are repeated, only their sums.
    """
    starts = F.sequence(F.col("pane") - F.lit(width_panes - 1), F.col("pane"))
    spread = merge_panes(panes, by).withColumn("_start", F.explode(starts))
    summed = spread.groupBy(*by, "_start").agg(F.sum("events").alias("events"), F.sum("total").alias("total"))
    start = F.timestamp_seconds(F.col("_start") * slide_seconds).cast("timestamp_ntz")
    return summed.select(*by, start.alias("window_start"), "events", "total")


def sliding(stream: DataFrame, at: str, slide_seconds: int, by: Sequence[str], value: str, path: str, fan_out: int = levels.FAN_OUT):
    """Follow a stream: panes per batch, merged by levels; windows are made when they are read."""
    merge = lambda parts: merge_panes(parts, by)
    return stream.writeStream.foreachBatch(lambda b, n: levels.add(pane_parts(b, at, slide_seconds, by, value), n, path, merge, fan_out))
