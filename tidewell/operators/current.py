"""Latest-row semantics, change application and incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.operators.scan import numbered

EPOCH_DAY, EPOCH = "1970-01-01", "1900-01-01 00:00:00"


def latest(
    df: DataFrame,
    keys: Sequence[str],
    version: str | Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest version; rows marked deleted are dropped afterwards.

    ``version`` may name several columns; later ones break ties, because equal versions have no order of
    their own.  ``max_by`` is combined on the map side, so a key with very many versions never has to
    be brought together in one task.
    """
    versions = [version] if isinstance(version, str) else list(version)
    rest = [c for c in df.columns if c not in set(keys)]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(v) for v in versions])).alias("_newest")
    )
    out = newest.select(*keys, *[F.col("_newest")[c].alias(c) for c in rest]).select(*df.columns)
    return out if deleted is None else out.where(F.coalesce(F.col(deleted).cast("int"), F.lit(0)) == 0)


def latest_by_rank(df: DataFrame, keys: Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """The same choice as a ranking; handy when the rank itself is wanted.  Prefer :func:`latest` for hot keys."""
    versions = [version] if isinstance(version, str) else list(version)
    order = Window.partitionBy(*keys).orderBy(*[F.col(v).desc() for v in versions])
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def update_from(
    base: DataFrame, staged: DataFrame, keys: Sequence[str], columns: Sequence[str], version: str | Sequence[str] | None = None
) -> DataFrame:
    """Replace ``columns`` of existing keys by the staged values; keys only in ``staged`` are ignored.

    Of several staged rows of a key the one with the greatest version counts, without a version the one with the
    greatest values, so a row of ``base`` stays one row and the result does not depend on the order of arrival.
    """
    values = F.struct(*[F.col(c) for c in columns])
    order = [] if version is None else [version] if isinstance(version, str) else list(version)
    chosen = F.max_by(values, F.struct(*order, *columns)) if order else F.max(values)
    marked = staged.groupBy(*keys).agg(chosen.alias("_new"))
    joined = base.join(marked, list(keys), "left")
    return joined.select(*[F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def upsert(log: DataFrame, changes: DataFrame, keys: Sequence[str], version: str, order: Sequence[str] = ()) -> DataFrame:
    """Append changes as new versions of their keys; read the result with :func:`latest`.

    Several changes of a key get versions of their own, one after the other in the order of ``order`` (rows that are
    equal there by a hash of the row).
    """
    top = log.groupBy(*keys).agg(F.max(version).alias("_top"))
    placed = (
        numbered(changes.drop(version), keys, list(order), "_number")
        .join(top, list(keys), "left")
        .withColumn(version, (F.coalesce(F.col("_top"), F.lit(-1)) + F.col("_number")).cast(log.schema[version].dataType))
    )
    return log.unionByName(placed.select(*log.columns))


def high_water_mark(target: DataFrame, column: str, floor: str | Column) -> Column:
    """``max(column)`` of the target as a scalar subquery; an empty target starts at ``floor``, not at NULL."""
    start = F.lit(floor) if isinstance(floor, str) else floor
    kind = target.schema[column].dataType
    return target.agg(F.coalesce(F.max(column), start.cast(kind)).alias("mark")).scalar()


def new_days(source: DataFrame, target: DataFrame, day: str) -> DataFrame:
    """Rows of days after the newest day of the target.

    The rule is strict: rows that arrive late for a day already loaded are not picked up.  On a
    source partitioned by ``day`` the subquery becomes a partition filter, so old days are not even listed.
    """
    return source.where(F.col(day) > high_water_mark(target, day, EPOCH_DAY))


def increment(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    arrived: str,
    overlap: str = "1 minute",
    epoch: str = EPOCH,
) -> DataFrame:
    """Rows not yet in the target, looked for from ``overlap`` before its newest arrival time.

    ``keys`` identify one version of a row.  A run that failed leaves the target, and so the mark, where it
    was: the next run sees the same rows.  A second run over the same data gives no rows.
    """
    low = high_water_mark(target, arrived, epoch) - F.expr(f"INTERVAL {overlap}")
    seen = target.where(F.col(arrived) >= low).select(*keys)
    return source.where(F.col(arrived) >= low).join(seen, list(keys), "left_anti")


def increment_with_keys(
    source: DataFrame,
    target: DataFrame,
    pending: DataFrame,
    known_keys: DataFrame,
    key_column: str,
    keys: Sequence[str],
    arrived: str,
    overlap: str = "1 minute",
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`increment` for rows that also need an entry in ``known_keys``.

    Gives (ready, pending).  Rows whose entry is missing are kept in the pending set and offered again to
    the next run, because by then the mark may have passed them.
    """
    fresh = increment(source, target, keys, arrived, overlap)
    waiting = pending.select(*source.columns).join(target.select(*keys), list(keys), "left_anti")
    offered = fresh.unionByName(waiting).dropDuplicates(list(keys))
    entries = known_keys.select(key_column).distinct()
    return offered.join(entries, key_column, "left_semi"), offered.join(entries, key_column, "left_anti")


def lag(source: DataFrame, target: DataFrame, keys: Sequence[str], version: str, arrived: str, deleted: str) -> DataFrame:
    """One row: seconds the target trails the source, and live rows it lacks."""
    live_source = latest(source, keys, version, deleted)
    live_target = latest(target, keys, version, deleted)
    seconds = lambda df: F.unix_timestamp(df.agg(F.max(arrived).cast("timestamp").alias("t")).scalar())
    return source.sparkSession.range(1).select(
        (seconds(source) - seconds(target)).alias("behind_s"),
        (
            live_source.agg(F.count("*").alias("n")).scalar() - live_target.agg(F.count("*").alias("n")).scalar()
        ).alias("rows_missing"),
    )


def verify_live(
    live: DataFrame, expected: DataFrame, keys: Sequence[str], fields: Sequence[str], deleted: str = "deleted"
) -> DataFrame:
    """Compare a live table with the expected state, both with one row per key.

    Counts expected live rows, rows seen, rows nobody expects, rows that should be gone, and rows with
    every field right.
    """
    want = expected.select(
        *keys, *[F.col(f).alias(f"_want_{f}") for f in fields], F.col(deleted).alias("_gone"), F.lit(True).alias("_known")
    )
    joined = live.withColumn("_seen", F.lit(True)).join(want, list(keys), "full_outer")
    seen, known = F.coalesce("_seen", F.lit(False)), F.coalesce("_known", F.lit(False))
    gone = F.coalesce(F.col("_gone").cast("int"), F.lit(0)) == 1
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_want_{f}"))
    return joined.agg(
        F.count_if(known & ~gone).alias("expected_live"),
        F.count_if(seen).alias("rows"),
        F.count_if(seen & ~known).alias("unexpected_rows"),
        F.count_if(seen & known & gone).alias("deleted_still_visible"),
        F.count_if(seen & known & ~gone & same).alias("all_fields_ok"),
    )


def run_record(df: DataFrame, job: str, read_rows: Column, written_rows: Column) -> DataFrame:
    """One row for a run-log table: what an increment read and wrote, and when."""
    return df.agg(read_rows.alias("read_rows"), written_rows.alias("written_rows")).select(
        F.lit(job).alias("job"), F.current_timestamp().alias("finished_at"), "read_rows", "written_rows"
    )


def run_report(log: DataFrame) -> DataFrame:
    """Per job: runs, rows read and written, last run and last run that wrote something."""
    return log.groupBy("job").agg(
        F.count("*").alias("runs"),
        F.sum("read_rows").alias("read_rows"),
        F.sum("written_rows").alias("written_rows"),
        F.max("finished_at").alias("last_run"),
        F.max(F.when(F.col("written_rows") > 0, F.col("finished_at"))).alias("last_write"),
    )
