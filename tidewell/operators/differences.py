"""Where two tables differ, by a hash tree over their keys.

A key's leaf is the first ``DEPTH`` bits of its hash. Each side is stored sorted by leaf, once, with a digest (rows, sum
of row hashes) per leaf; the digest of a shorter prefix is the sum of those below it. From the root down only children of
prefixes that differ are compared, and only rows of leaves that differ are read again and joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a leaf, and bits that one level of the tree adds. There are 2^DEPTH leaves at most, whatever the tables' size.
DEPTH, STEP = 16, 4

_LEAF = "_leaf"


def _row_hash(columns: Sequence[str]):
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"}))


def store_hashed(df: DataFrame, root: str, keys: Sequence[str], version: str = "now") -> None:
    """Write the rows sorted by leaf, and their digests. Many rows of one leaf are split by a hash of the row."""
    leaf = F.shiftrightunsigned(F.xxhash64(*keys), 64 - DEPTH).cast("int")
    rows = df.withColumn(_LEAF, leaf).withColumn("_hash", _row_hash(df.columns))
    rows.repartitionByRange(_LEAF, "_hash").sortWithinPartitions(_LEAF).write.mode("overwrite").parquet(f"{root}/rows/of={version}")
    written = df.sparkSession.read.schema(rows.schema).parquet(f"{root}/rows/of={version}")
    digests = written.groupBy(_LEAF).agg(F.count("*").alias("rows"), F.sum(F.col("_hash").cast("decimal(38,0)")).alias("hash_sum"))
    digests.write.mode("overwrite").parquet(f"{root}/digests/of={version}")


def _digests(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.schema(f"{_LEAF} int, rows long, hash_sum decimal(38,0)").parquet(f"{root}/digests/of={version}")


def differing_leaves(spark: SparkSession, left: str, right: str, version: str = "now") -> list[int]:
    """Leaves whose digests differ, found from the root down."""
    sides = _digests(spark, left, version).withColumn("_side", F.lit(1)).unionByName(_digests(spark, right, version).withColumn("_side", F.lit(-1)))
    known: list[int] | None = None
    for bits in range(STEP, DEPTH + 1, STEP):
        prefix = F.shiftright(F.col(_LEAF), DEPTH - bits)
        # The leaves of a prefix are a range; the list holds prefixes of one level, so at most 2^bits numbers.
        below = sides if known is None else sides.where(F.shiftright(F.col(_LEAF), DEPTH - bits + STEP).isin(known))
        sums = below.groupBy(prefix.alias("prefix")).agg(F.sum(F.col("rows") * F.col("_side")).alias("r"), F.sum(F.col("hash_sum") * F.col("_side")).alias("h"))
        known = [r.prefix for r in sums.where("r <> 0 OR h <> 0").collect()]
        if not known:
            return []
    return sorted(known)


def rows_to_compare(spark: SparkSession, root: str, schema, leaves: Sequence[int], version: str = "now") -> DataFrame:
    """The stored rows of these leaves; sorted as they are, other row groups are passed over."""
    stored = T.StructType([*schema.fields, T.StructField(_LEAF, T.IntegerType()), T.StructField("_hash", T.LongType())])
    rows = spark.read.schema(stored).parquet(f"{root}/rows/of={version}")
    return rows.where(F.col(_LEAF).isin(list(leaves)) & F.col(_LEAF).between(min(leaves, default=0), max(leaves, default=-1)))


def locate(spark: SparkSession, left: str, right: str, schema, keys: Sequence[str], version: str = "now") -> DataFrame:
    """Keys that differ, with ``found`` (``left``, ``right``: on that side only; ``both``: other values) and the columns
    that do. Keys are taken to be unique within a side; null keys compare as equal."""
    leaves = differing_leaves(spark, left, right, version)
    values = [c for c in schema.names if c not in keys]

    def side(root: str, name: str) -> DataFrame:
        rows = rows_to_compare(spark, root, schema, leaves, version)
        return rows.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct("_hash", *values).alias(name))

    a, b = side(left, "_a"), side(right, "_b")
    same_key = [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    condition = same_key[0]
    for c in same_key[1:]:
        condition = condition & c
    met = a.join(b, condition, "full_outer").where(~F.col("_a._hash").eqNullSafe(F.col("_b._hash")))
    differs = F.array_compact(F.array(*[F.when(~F.col("_a")[c].eqNullSafe(F.col("_b")[c]), F.lit(c)) for c in values])).cast("array<string>")
    alone = F.when(F.col("_b").isNull(), "left").when(F.col("_a").isNull(), "right").otherwise("both")
    return met.select(*[F.coalesce(F.col(f"_a_{k}"), F.col(f"_b_{k}")).alias(k) for k in keys], alone.alias("found"), F.when(alone == "both", differs).alias("columns"))
