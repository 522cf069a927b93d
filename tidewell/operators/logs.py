"""Log analytics: statement statistics, benchmark summaries, call counts, staleness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import ratio, readable_bytes
from tidewell.operators.totals import nearest_rank

# The quantiles of a latency summary.
LATENCY_POINTS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
STALE_POINTS = {"p50": 0.5, "p99": 0.99}


def counter(name: str, counters: str = "counters") -> Column:
    """A counter of a log row's map, 0 where it is absent."""
    return F.coalesce(F.try_element_at(counters, F.lit(name)), F.lit(0))


def statement_stats(log: DataFrame, like: str, not_like: str, counters: Sequence[str]) -> DataFrame:
    """Seconds, rows, bytes, memory and counters of every finished or failed statement of a run."""
    return (
        log.where(F.col("query_id").like(like) & ~F.col("query_id").like(not_like))
        .where(F.col("type").isin("QueryFinish", "ExceptionBeforeStart", "ExceptionWhileProcessing"))
        .select(
            "query_id",
            "hostname",
            "event_time",
            F.round(F.col("duration_ms") / 1000, 2).alias("seconds"),
            "read_rows",
            readable_bytes(F.col("read_bytes")).alias("read"),
            "written_rows",
            readable_bytes(F.col("memory_usage")).alias("memory"),
            *[counter(c).alias(c) for c in counters],
            (counter("UserTimeMicroseconds") / F.lit(1e6)).alias("cpu_user_s"),
            "exception_code",
        )
    )


def run_stats(log: DataFrame, run_pattern: str) -> DataFrame:
    """Per benchmark run: statements, failures, latency of the finished ones, rows, CPU, hosts and error codes."""
    done = F.col("type") == "QueryFinish"
    return (
        log.where((F.col("type") != "QueryStart") & F.col("run_id").rlike(run_pattern))
        .groupBy("run_id")
        .agg(
            F.count_if(done).alias("queries"),
            F.count_if(~done).alias("failed"),
            F.round(F.avg(F.when(done, F.col("duration_ms"))), 2).alias("avg_ms"),
            F.percentile_approx(F.when(done, F.col("duration_ms")), 0.99).alias("p99_ms"),
            F.sum("read_rows").alias("read_rows"),
            F.sum("read_bytes").alias("read_bytes"),
            F.sum(counter("CpuMicroseconds")).alias("cpu_us"),
            F.count_distinct("hostname").alias("replicas"),
            F.array_sort(F.collect_set(F.when(F.col("exception_code") != 0, F.col("exception_code")))).alias(
                "exception_codes"
            ),
        )
    )


def latency_summary(requests: DataFrame, groups: Sequence[str], micros: str) -> DataFrame:
    """Nearest-rank latency quantiles per run, in milliseconds."""
    ranked = nearest_rank(requests, groups, micros, LATENCY_POINTS)
    ms = lambda c: (F.col(c) / 1000).alias(f"{c}_ms")
    return ranked.select(*groups, F.col("n").alias("requests"), *[ms(c) for c in ["mean", *LATENCY_POINTS, "max"]])


def peak_per_second(requests: DataFrame, groups: Sequence[str], at: str) -> DataFrame:
    """Most requests within one second, per run."""
    per_second = requests.groupBy(*groups, F.date_trunc("second", F.col(at)).alias("_s")).agg(F.count("*").alias("_n"))
    return per_second.groupBy(*groups).agg(F.max("_n").alias("peak_per_s"))


def benchmark_summary(requests: DataFrame, groups: Sequence[str], at: str, micros: str, hit: str, duration: str) -> DataFrame:
    """Latency, requests per second, hit ratio and peak per run from a request log."""
    rates = requests.groupBy(*groups).agg(
        (F.count("*") / F.max(duration)).alias("qps"),
        ratio(F.count_if(F.col(hit)), F.count(hit)).alias("hit_ratio"),
    )
    return (
        latency_summary(requests, groups, micros)
        .join(rates, list(groups))
        .join(peak_per_second(requests, groups, at), list(groups))
    )


def staleness(answers: DataFrame, groups: Sequence[str], answered_at: str, newest: str) -> DataFrame:
    """How old the answers were: answer time minus newest row, p50, p99 and maximum in seconds."""
    age = answers.where(F.col(newest).isNotNull()).withColumn("_age", F.col(answered_at) - F.col(newest))
    ranked = nearest_rank(age, groups, "_age", STALE_POINTS)
    return ranked.select(*groups, F.col("n").alias("answers"), "p50", "p99", "max")


def fill_missing_stats(results: DataFrame, posthoc: DataFrame, columns: Sequence[str], key: str = "run_id") -> DataFrame:
    """Statistics taken during the run, or those read afterwards where there are none; says which."""
    later = posthoc.select(key, *[F.col(c).alias(f"_later_{c}") for c in columns], F.lit(True).alias("_later"))
    own = F.lit(False)
    for c in columns:
        own = own | F.col(c).isNotNull()
    joined = results.join(later, key, "left")
    source = F.when(own, "in run").when(F.col("_later"), "posthoc").otherwise("none")
    return joined.select(
        *[
            F.when(own, F.col(c)).otherwise(F.col(f"_later_{c}")).alias(c) if c in columns else F.col(c)
            for c in results.columns
        ],
        source.alias("stats_from"),
    )


def calls_by_caller(events: DataFrame, first: Column, last: Column) -> DataFrame:
    """Calls by name and whole caller within a closed time window."""
    return events.where(F.col("at").between(first, last)).groupBy("name", "agent").agg(F.count("*").alias("calls"))
