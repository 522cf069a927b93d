"""What the operators share: registration, session settings, stored intermediate tables, character classes."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidewell.workspace import apply_settings, scratch

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

#: Rows and bytes of one Arrow batch: Python tasks see a few MB of text at a time, however long the texts are.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tune(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: later steps share one computation, whose result
    outlives the executors."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- characters ---------------------------------------------------------------------------------------------

OTHER, LETTER, NUMBER, SPACE = range(4)

# The code points with the Unicode property White_Space.
_WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Letters and numbers of Unicode 16, for a Python whose tables are older.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point: letter (L*), number (N*), white space, other."""
    of = {"L": LETTER, "N": NUMBER}
    kinds = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for ranges, kind in ((_NEW_LETTERS, LETTER), (_NEW_NUMBERS, NUMBER)):
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[list(_WHITE)] = SPACE
    return kinds


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def groups_of(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
