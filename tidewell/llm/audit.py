"""How filters overlap: what each removes in every order of application, by a Gray-code walk over their subsets.

A row's failures make a mask, and rows are counted once per part and mask: at most 2^k cells for k filters. The walk
then visits all subsets of filters so that neighbours differ in one: it toggles that filter, moves the counter of
active failures of every cell that fails it by one, and takes the cell out of the running survivors when its counter
leaves zero, or puts it back when it returns to zero. The survivors of each subset are stored; what a filter removes
at a step of an order is the difference of two stored states.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import stored, tune

_WORD = r"[^\x20\x09-\x0D]+"
#: The filters of ``text_failures`` and of copies, in the order of their bits.
LETTERS = "ABCDE"


def text_failures(text: Column) -> list[Column]:
    """The filters that look at a text alone: short, repetitive, shouting, symbols. A null text counts as empty."""
    words, size = F.col("_words"), F.size("_words")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return [size < 200, 100 * F.size(F.array_distinct(words)) < 50 * size, 100 * capitals > 2 * F.char_length(text), text.rlike("[#$%&*|]")]


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows per source and set of failed filters.

    A text is a copy when a row with a smaller doc_id has the identical text; a row without an id is never a copy,
    nor are rows that share the smallest id. A null source is the empty string. A document is good or toxic when any
    of its label rows says so.
    """
    spark = tune(docs.sparkSession)
    flags = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    # Stored, so that the join sees a table and not an aggregate, and can split an id that many rows share.
    flags = stored(flags, "audit-flags")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    read = docs.select(docs["doc_id"], F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"), text.alias("_text"))
    read = read.withColumn("_words", F.regexp_extract_all("_text", F.lit(_WORD), F.lit(0)))
    mask = sum((F.when(failed, F.lit(1 << k)).otherwise(F.lit(0)) for k, failed in enumerate(text_failures(F.col("_text")))), F.lit(0))
    slim = read.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("_text", 256)).alias("digest"))
    told = slim.join(flags, "doc_id", "left").select(
        "doc_id", "part", "mask", "digest", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    per_id = told.groupBy("digest", "part", "mask", "doc_id").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # Of each text in each part: all rows, those of the smallest id, those without an id.
    counts = F.struct("n", "good", "toxic")
    per_part = per_id.groupBy("digest", "part", "mask").agg(
        F.min("doc_id").alias("least"),
        F.min_by(F.when(F.col("doc_id").isNotNull(), counts), "doc_id").alias("first"),
        *sums,
        *[F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(0)).alias(f"loose_{c}") for c in ("n", "good", "toxic")],
    )
    # A text has one row here per part and mask, so a window over a text is bounded by the number of parts.
    whole = per_part.withColumn("_least", F.min("least").over(Window.partitionBy("digest")))
    held = F.col("least") == F.col("_least")
    passing = [(F.col(f"loose_{c}") + F.when(held, F.col(f"first.{c}")).otherwise(0)).alias(f"pass_{c}") for c in ("n", "good", "toxic")]
    split = whole.select("part", "mask", "n", "good", "toxic", *passing)
    per_mask = split.groupBy("part", "mask").agg(*sums, *[F.sum(f"pass_{c}").alias(f"pass_{c}") for c in ("n", "good", "toxic")])
    copy = 1 << (len(LETTERS) - 1)
    sides = F.array(
        F.struct("mask", *[F.col(f"pass_{c}").alias(c) for c in ("n", "good", "toxic")]),
        F.struct((F.col("mask") + copy).alias("mask"), *[(F.col(c) - F.col(f"pass_{c}")).alias(c) for c in ("n", "good", "toxic")]),
    )
    return per_mask.select("part", F.inline(sides)).where("n > 0")


def subset_survivors(cells: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters: cells[mask] of any further shape -> survivors[subset] of the same.

    Subset s has a bit for each filter that is applied. Each step of the walk toggles one filter.
    """
    states = np.zeros_like(cells)
    failures = np.zeros(1 << filters, np.int64)
    running = cells.sum(axis=0)
    states[0] = running
    subset = 0
    for step in range(1, 1 << filters):
        toggled = (step & -step).bit_length() - 1
        subset ^= 1 << toggled
        on = subset >> toggled & 1
        for cell in range(1 << filters):
            if cell >> toggled & 1:
                before = failures[cell]
                failures[cell] += 1 if on else -1
                if not before:
                    running = running - cells[cell]
                elif not failures[cell]:
                    running = running + cells[cell]
        states[subset] = running
    return states


def _report(states: np.ndarray, filters: int) -> Iterator[tuple[tuple[int, ...], list[np.ndarray]]]:
    """For every order its columns by step; states[subset, measure, part], measures: all, good, toxic rows."""
    every = (1 << filters) - 1
    orders = list(itertools.permutations(range(filters)))
    total = np.zeros((filters, states.shape[2]), np.int64)
    steps = []
    for order in orders:
        rows, before = [], 0
        for f in order:
            after = before | 1 << f
            removed = states[before] - states[after]
            total[f] += removed[0]
            failing = states[0, 0] - states[1 << f, 0]
            unique = states[every ^ 1 << f, 0] - states[every, 0]
            rows.append([states[after, 0], removed[0], failing - removed[0], unique, removed[1], removed[2], f])
            before = after
        steps.append(rows)
    for order, rows in zip(orders, steps):
        yield order, [[*row[:-1], total[row[-1]]] for row in rows]


MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(cells: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """One row per part, order of all filters and step, from (part, mask, n, good, toxic).

    A part has at most 2^k cells, so it is one row of arrays; the walk runs over a batch of parts at once. Repeated
    cells of a part are added up, null counts are 0. No cells give no rows.
    """
    k = len(letters)
    size = 1 << k
    order_name = {order: "".join(letters[f] for f in order) for order in itertools.permutations(range(k))}
    per_cell = cells.groupBy("part", "mask").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "good", "toxic")])
    arrays = per_cell.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.array("n", "good", "toxic")))).alias("m"))
    dense = arrays.select("part", F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.col("m")[i], F.array(*[F.lit(0).cast("long")] * 3)))).alias("m"))
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in MEASURES)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = b.num_rows
            if not parts:
                continue
            counts = b.column("m").flatten().to_numpy().astype(np.int64).reshape(parts, size, 3).transpose(1, 2, 0)
            for order, rows in _report(subset_survivors(counts, k), k):
                for step, columns in enumerate(rows, 1):
                    same = [pa.array([order_name[order]] * parts), pa.array(np.full(parts, step, np.int32))]
                    yield pa.RecordBatch.from_arrays([b.column("part"), *same, *map(pa.array, columns)], schema.names)

    return dense.mapInArrow(run, schema)
