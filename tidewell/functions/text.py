"""Small text, number and time helpers used by several jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names of the readable size.
SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def readable_bytes(size: Column) -> Column:
    """Bytes as text with the largest binary unit below 1024; whole bytes carry no decimals."""
    number = size.cast("double")
    out = F.when(number < 1024, F.concat(number.cast("bigint").cast("string"), F.lit(" " + SIZE_UNITS[0])))
    for power, unit in enumerate(SIZE_UNITS[1:-1], start=1):
        out = out.when(number < 1024.0 ** (power + 1), F.format_string("%.2f " + unit, F.bround(number / 1024.0**power, 2)))
    top = len(SIZE_UNITS) - 1
    return F.when(number.isNull(), None).otherwise(
        out.otherwise(F.format_string("%.2f " + SIZE_UNITS[top], F.bround(number / 1024.0**top, 2)))
    )


def first_letter_mask(value: Column) -> Column:
    """First character, then ``***``; characters, not bytes.  NULL stays NULL."""
    return F.concat(F.substring(value, 1, 1), F.lit("***"))


def ratio(part: Column, whole: Column) -> Column:
    """A division that gives NULL instead of an error for an empty whole."""
    return part / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100) * ratio(part, whole), digits)


def int_or_zero(value: Column) -> Column:
    """Whole number from text, 0 where it is none."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def double_or_null(value: Column) -> Column:
    return value.try_cast("double")


#: Shapes of time beside the ISO ones.
TIME_SHAPES = ("yyyy/MM/dd HH:mm:ss", "dd.MM.yyyy HH:mm", "yyyyMMddHHmmss")


def timestamp_or_null(value: Column, shapes: tuple[str, ...] = TIME_SHAPES) -> Column:
    """Text in ISO or one of the shapes -> timestamp, NULL where none fits."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(s)) for s in shapes], value.try_cast("timestamp"))


def truncate(unit: str, ts: Column) -> Column:
    """``date_trunc`` that gives back a timestamp without time zone, so results do not move with the session."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def minute(ts: Column) -> Column:
    return truncate("minute", ts)


def hour(ts: Column) -> Column:
    return truncate("hour", ts)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))
