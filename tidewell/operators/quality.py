"""Fingerprints, canonical result hashes, verdicts and reconciliations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.current import latest
from tidewell.operators.totals import literal_rows, union_labelled

_WORDS = (1, 16, 31, 46)  # four 15-digit words of a 64-digit hash; 15 hex digits fit a bigint


def _number_sum(column: Column) -> Column:
    return F.coalesce(F.sum(column.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count and an order-free sum of row hashes.

    The row is hashed as JSON because the field names keep values in their places; hashing the bare columns would
    not tell (a, NULL) from (NULL, a).
    """
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}))
    return df.agg(F.count("*").alias("rows"), _number_sum(row).cast("string").alias("hash_sum"))


def canonical_value(df: DataFrame, name: str) -> Column:
    """One value as comparable text: NULL as ``\\N``, numbers with two decimals (half up), text without trailing
    spaces, times in ISO form, bytes as hex."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.BooleanType):
        text = c.cast("string")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        exact = F.round(c.cast("double"), 2).try_cast("decimal(38,2)")
        text = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c.cast("string")).otherwise(
            F.coalesce(exact.cast("string"), c.cast("string"))
        )
    elif isinstance(kind, T.NumericType):
        text = F.round(c.cast("decimal(38,10)") if not isinstance(kind, T.DecimalType) else c, 2).cast("decimal(38,2)").cast("string")
    elif isinstance(kind, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(c, "SSSSSS")
        text = F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
    elif isinstance(kind, T.BinaryType):
        text = F.lower(F.hex(c))
    elif isinstance(kind, T.StringType):
        text = F.rtrim(c)
    else:
        text = F.to_json(F.struct(c))
    return F.coalesce(text, F.lit("\\N"))


def result_summary(df: DataFrame) -> DataFrame:
    """One row: rows, an order-free hash of the canonical rows, and the sums of the numeric columns.

    Per row a SHA-256; the rows are combined by adding the hash words, so equal multisets of rows give
    equal hashes and no task ever has to hold or sort the whole result.
    """
    line = F.sha2(F.concat_ws("|", *[canonical_value(df, c) for c in df.columns]), 256)
    words = [_number_sum(F.conv(F.substring(F.col("_line"), at, 15), 16, 10)).alias(f"_w{at}") for at in _WORDS]
    numeric = [
        c for c in df.columns if isinstance(df.schema[c].dataType, T.NumericType)
    ]
    sums = [F.sum(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(numeric)]
    one = df.withColumn("_line", line).agg(F.count("*").alias("rows"), *words, *sums)
    positions = [
        F.round(F.col(f"_s{numeric.index(c)}"), 2) if c in numeric else F.lit(None).cast("double") for c in df.columns
    ]
    combined = F.sha2(
        F.concat_ws(":", F.col("rows").cast("string"), *[F.col(f"_w{at}").cast("string") for at in _WORDS]), 256
    )
    return one.select("rows", combined.alias("result_hash"), F.array(*positions).alias("col_sums"))


def last_runs(results: DataFrame, keys: Sequence[str], finished: str) -> DataFrame:
    """Append-only results: the last run of a key counts."""
    return latest(results, keys, finished)


#: State of a run, and for a run that went well whether its reference did and whether the hashes are the same.
_RULES = [
    *[(state, wanted, same, verdict) for state, verdict in (("none", "not run"), ("syntax", "syntax"), ("failed", "error")) for wanted in (True, False) for same in (True, False)],
    *[("ok", False, same, "error") for same in (True, False)],
    ("ok", True, True, "match"),
    ("ok", True, False, "mismatch"),
]


def verdicts(reference: DataFrame, results: DataFrame, name: str = "query") -> DataFrame:
    """(query, verdict, rows_found, rows_expected, column_off): one verdict per query of the reference.

    Both sides carry (query, status, rows, result_hash, col_sums). ``column_off`` is the place, from 1, of the first
    column whose sum differs by more than 0.05 and more than one millionth; NULL when all agree.
    """
    sides = reference.select(name, F.struct("status", "rows", "result_hash", "col_sums").alias("want")).join(
        results.select(name, F.struct("status", "rows", "result_hash", "col_sums").alias("got")), name, "left"
    )
    known = F.array(F.lit("ok"), F.lit("syntax"))
    status = F.col("got.status")
    keyed = sides.withColumns(
        {
            "state": F.when(status.isNull(), "none").when(F.array_contains(known, status), status).otherwise("failed"),
            "wanted": F.coalesce(F.col("want.status") == "ok", F.lit(False)),
            "same": F.coalesce(F.col("got.result_hash") == F.col("want.result_hash"), F.lit(False)),
        }
    )

    def off(a: Column, b: Column) -> Column:
        apart = F.abs(a - b)
        return ~(a.eqNullSafe(b) | F.coalesce((apart <= 0.05) | (apart * 1_000_000 <= F.abs(b)), F.lit(False)))

    places = F.array_position(F.zip_with("got.col_sums", "want.col_sums", off), True)
    rules = literal_rows(reference.sparkSession, _RULES, "state string, wanted boolean, same boolean, verdict string")
    return keyed.join(rules, ["state", "wanted", "same"]).select(
        name, "verdict", F.col("got.rows").alias("rows_found"), F.col("want.rows").alias("rows_expected"), F.when(places > 0, places).alias("column_off")
    )


def agreement(sources: Mapping[str, DataFrame], value: Column) -> DataFrame:
    """Rows and a sum per source of the same data, with one flag that is true when all sources agree."""
    labelled = union_labelled(
        {n: df.agg(F.count("*").alias("rows"), F.sum(value).alias("value")) for n, df in sources.items()}, "source"
    )
    spread = labelled.agg((F.count_distinct("rows", "value") == 1).alias("same")).scalar()
    return labelled.select("source", "rows", "value", spread.alias("agree"))


def reconcile(found: DataFrame, expected: DataFrame, name: str = "table") -> DataFrame:
    """Row counts found and expected per table, status ``ok`` or ``rows_differ``."""
    joined = expected.withColumnRenamed("rows", "expected_rows").join(found, name, "full_outer")
    return joined.select(
        name,
        F.col("rows"),
        F.col("expected_rows"),
        F.when(F.col("expected_rows").isNull() | F.col("rows").eqNullSafe(F.col("expected_rows")), "ok")
        .otherwise("rows_differ")
        .alias("status"),
    )


def content_hash(props: Column) -> Column:
    """MD5 of a property map: ``key=value`` pairs sorted by key, joined by the unit separator."""
    pairs = F.transform(
        F.array_sort(F.map_entries(props)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.md5(F.array_join(pairs, "\x1f").cast("binary"))


def same_map(a: Column, b: Column) -> Column:
    """Maps have no order: compare the sorted entries."""
    return F.array_sort(F.map_entries(a)) == F.array_sort(F.map_entries(b))
