"""Aggregations, shares, roll-ups, unpivots and unions used across the jobs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions.text import percent


def distinct_per_group(df: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact distinct count per group in two steps.

    The first step removes duplicates on (group, value), before and after the shuffle, so a group that
    holds a third of all rows is already spread over all tasks when it is counted.
    """
    return (
        df.select(*groups, column).where(F.col(column).isNotNull()).distinct().groupBy(*groups).agg(F.count("*").alias(name))
    )


def share_of_group(df: DataFrame, value: str, groups: Sequence[str], name: str = "share_pct") -> DataFrame:
    """Percent of the group's total per row.  The totals come from an aggregate joined back, so rows of one big
    group stay spread out; a window would sort the whole group in one task."""
    totals = df.groupBy(*groups).agg(F.sum(value).alias("_total"))
    return df.join(totals, list(groups), "left").withColumn(name, percent(F.col(value), F.col("_total"))).drop("_total")


def share_of_all(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Percent of the grand total: a scalar subquery, because ``sum() over ()`` would move every row to one task."""
    total = df.agg(F.sum(value).alias("t")).scalar()
    return df.withColumn(name, percent(F.col(value), total))


def with_grand_total(df: DataFrame, label: str, total_label: str, sums: Mapping[str, Column]) -> DataFrame:
    """Group sums plus one total row, told apart by ``grouping()`` so that a blank label is not taken for it."""
    return (
        df.rollup(label)
        .agg(F.grouping(label).alias("_is_total"), *[c.alias(n) for n, c in sums.items()])
        .withColumn(label, F.when(F.col("_is_total") == 1, F.lit(total_label)).otherwise(F.col(label)))
        .withColumnRenamed("_is_total", "is_total")
    )


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Metric columns to (name, value) rows; ``metrics`` maps a column to its label."""
    pairs = F.array(*[F.struct(F.lit(l).alias(name), F.col(c).cast("double").alias(value)) for c, l in metrics.items()])
    return df.select(*ids, F.inline(pairs))


#: Distinct values that one task ranks at a time, about.
_RANGE_VALUES = 100_000


def nearest_rank(df: DataFrame, groups: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Exact nearest-rank quantiles with mean and maximum per group.

    Values are counted first, so what is ranked is one row per distinct value; ranks are then running counts
    over (group, range) and not a list of all values of a group in one task.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("_n"))
    return nearest_rank_counted(counted, groups, value, "_n", points)


def nearest_rank_counted(
    counted: DataFrame, groups: Sequence[str], value: str, weight: str, points: Mapping[str, float], range_values: int = _RANGE_VALUES
) -> DataFrame:
    """Nearest-rank quantiles of weighted values: the smallest value whose running weight reaches ceil(p * n)."""
    groups = list(groups)
    # Values are dealt into ranges of about equal depth by a sketch of the whole group, as many as its number of distinct
    # values asks for; the ranges only steer the work, ranks stay exact.
    number = F.col(value).cast("double")
    sketch = counted.groupBy(*groups).agg(
        F.sum(weight).alias("_total"),
        F.sum(F.col(value) * F.col(weight)).alias("_sum"),
        F.ceil(F.count("*") / F.lit(range_values)).cast("int").alias("_ranges"),
        F.percentile_approx(number, F.array(*[F.lit(i / 1024) for i in range(1, 1024)]), F.lit(10_000)).alias("_points"),
        F.max(value).alias("max"),
    )
    # Every k-th point is a cut; beyond 1024 ranges the points are divided further by evenly spaced values.
    step = F.greatest(F.lit(1), F.floor(F.lit(1024) / F.col("_ranges"))).cast("int")
    bounds = sketch.withColumn("_cuts", F.filter("_points", lambda x, i: (i + 1) % step == 0)).withColumn(
        "_finer", F.greatest(F.lit(1), F.ceil(F.col("_ranges") / 1024)).cast("long")
    ).drop("_points", "_ranges")
    at = F.size(F.filter("_cuts", lambda cut: cut < number))
    low, high = F.get("_cuts", at - 1), F.get("_cuts", at)
    share = F.when(high > low, (number - low) / (high - low)).otherwise(0.0)
    inner = F.least(F.floor(share * F.col("_finer")), F.col("_finer") - 1)
    ranged = counted.join(bounds, groups).withColumn("_range", at * F.col("_finer") + F.coalesce(inner, F.lit(0))).drop("_cuts", "_finer")
    per_range = ranged.groupBy(*groups, "_range").agg(F.sum(weight).alias("_weight"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(*groups, "_range", F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*groups, "_range").orderBy(value)
    placed = ranged.join(offsets, [*groups, "_range"]).withColumn("_upto", F.col("_before") + F.sum(weight).over(inside))
    reach = {
        name: F.min(F.when(F.col("_upto") >= F.greatest(F.ceil(F.lit(p) * F.col("_total")), F.lit(1)), F.col(value)))
        for name, p in points.items()
    }
    return placed.groupBy(*groups).agg(
        F.any_value("_total").alias("n"),
        F.any_value(F.col("_sum") / F.col("_total")).alias("mean"),
        *[c.alias(n) for n, c in reach.items()],
        F.any_value("max").alias("max"),
    )


def fixed_rows(df: DataFrame, wanted: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The wanted row set with the values found, 0 where there is none."""
    joined = wanted.join(df, list(on), "left")
    return joined.select(*on, *[F.coalesce(F.col(v), F.lit(0.0)).alias(v) for v in values])


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal row set."""
    return spark.createDataFrame(list(rows), schema)


def union_labelled(branches: Mapping[str, DataFrame], label: str) -> DataFrame:
    """``UNION ALL`` of branches, each with its name in a column."""
    out = None
    for name, df in branches.items():
        part = df.withColumn(label, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def union_matching(spark: SparkSession, pattern: str, database: str | None = None) -> DataFrame:
    """All tables and views whose whole name matches the pattern, for logs that are rotated by renaming.

    The pattern is anchored: ``query_log(_[0-9]+)?`` reads query_log_1 and never query_log_copy.
    """
    anchored = re.compile(pattern)
    names = sorted(
        t.name
        for t in spark.catalog.listTables(database)
        if anchored.fullmatch(t.name) and (database is None or t.isTemporary or database in (t.namespace or []))
    )
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    out = None
    for name in names:
        part = spark.table(f"{database}.{name}" if database else name)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
