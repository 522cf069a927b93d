"""Best-fit packing into bins of several permitted lengths.

Documents longer than the longest permitted length are cut into full pieces and a rest. Pieces are dealt into
shards of about ``SHARD`` pieces by a hash, and each shard is packed on its own, longest piece first: a piece goes
into the open bin it leaves the least room in; if it fits in none, a bin is opened whose length costs least. The
cost of opening a bin of length L for a piece of length n is what is expected to be paid per token it will hold:
(L + the cost of a bin) / (n + what of the remaining room the shard's shorter pieces can fill). Room that only
a few pieces are left for counts by these alone, so long bins are opened while there is something to fill them
with. At the end each bin is downsized to the shortest permitted length that holds its contents.

The work of a shard is in numpy over at most ``SHARD`` numbers; texts take no part in it.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import partitions, stored, tune

LENGTHS = (512, 1024, 2048, 4096, 8192)
SHARD = 1500
#: Tokens that a bin costs beside its length (separators, a row of the output).
BIN_COST = 8


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, bin_cost: int = BIN_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each piece, and the length of each bin. Sizes are 1 to the longest length."""
    lengths = tuple(sorted(lengths))
    order = np.argsort(-sizes, kind="stable")
    left = sizes[order][::-1].cumsum()[::-1].tolist() if len(sizes) else []  # tokens from this piece on
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (room, bin) of open bins, sorted
    for rank, piece in enumerate(order.tolist()):
        n = int(sizes[piece])
        at = bisect.bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            others = left[rank] - n
            cost = lambda length: (length + bin_cost) / (n + min(length - n, others))
            free = min((x for x in lengths if x >= n), key=lambda x: (cost(x), x))
            b = len(used)
            used.append(0)
        bins[piece], offsets[piece] = b, used[b]
        used[b] += n
        if free > n:
            bisect.insort(room, (free - n, b))
    downsized = np.array([next(x for x in lengths if x >= u) for u in used], np.int64)
    return bins, offsets, downsized


def pieces(docs: DataFrame, length: str, id: str, longest: int) -> DataFrame:
    """(id, piece, start, n): documents cut at ``longest``; one without tokens has no piece."""
    n = F.col("n")
    count = F.ceil(n / longest).cast("int")
    return (
        docs.select(docs[f"`{id}`"].alias("id"), docs[f"`{length}`"].cast("long").alias("n"))
        .where(n > 0)
        .select("id", "n", F.posexplode(F.sequence(F.lit(0), count - 1)).alias("piece", "_"))
        .select("id", "piece", (F.col("piece").cast("long") * longest).alias("start"), F.least(F.lit(longest), n - F.col("piece") * longest).cast("long").alias("n"))
    )


def _pack_shards(lengths: tuple[int, ...], bin_cost: int):
    """Rows sorted by shard; the last shard of a batch waits for the next one."""

    def packed(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        shard = table.column("shard").to_numpy()
        sizes = table.column("n").to_numpy()
        starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        bins, offsets, capacity = (np.zeros(len(shard), np.int64) for _ in range(3))
        for a, b in zip(starts, np.append(starts[1:], len(shard))):
            of, at, length = pack(sizes[a:b], lengths, bin_cost)
            bins[a:b], offsets[a:b], capacity[a:b] = of, at, length[of]
        columns = [*table.columns, *(pa.chunked_array([pa.array(x)]) for x in (bins, offsets, capacity))]
        return pa.Table.from_arrays(columns, [*table.column_names, "bin", "offset", "capacity"]).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for b in batches:
            if not len(b):
                continue
            now = pa.Table.from_batches([b])
            now = now if kept is None else pa.concat_tables([kept, now])
            shard = now.column("shard").to_numpy()
            end = int(np.flatnonzero(shard != shard[-1])[-1]) + 1 if shard[0] != shard[-1] else 0
            if end:
                yield packed(now.slice(0, end))
            kept = now.slice(end)
        if kept is not None and len(kept):
            yield packed(kept)

    return run


def best_fit(docs: DataFrame, length: str, id: str = "doc_id", lengths: tuple[int, ...] = LENGTHS, shard: int = SHARD, bin_cost: int = BIN_COST) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``start`` and ``n_tokens`` of the piece in its document, and where it
    is packed: ``shard``, ``bin`` in the shard, ``offset`` in the bin, ``capacity`` of the bin.

    A document with no tokens or a null length has no row. Ties go by id. Repeated rows are packed as documents of
    their own. Other columns are not read. No rows give no rows.
    """
    spark = tune(docs.sparkSession)
    lengths = tuple(sorted(lengths))
    parts = stored(pieces(docs, length, id, lengths[-1]), "pieces")
    shards = max(1, -(-parts.count() // shard))
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("id", "piece"), F.lit(shards)))
    in_order = dealt.repartition(partitions(spark), "shard").sortWithinPartitions("shard", F.desc("n"), "id", "piece")
    schema = T.StructType([*in_order.schema.fields, *(T.StructField(n, T.LongType()) for n in ("bin", "offset", "capacity"))])
    return in_order.mapInArrow(_pack_shards(lengths, bin_cost), schema).select(
        F.col("id").alias(id), "piece", "start", F.col("n").alias("n_tokens"), "shard", "bin", "offset", "capacity"
    )
