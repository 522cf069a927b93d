"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.base import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of one integer type); root is the smallest node
    that can be reached.

    Alternates two steps until nothing changes. Large: each node hands its smallest neighbour to its larger
    neighbours. Small: each node links its smaller neighbours and itself to the smallest of them. Both keep the
    components and the number of links falls to one per node; the depth falls by about half a round. The minimum
    per node is combined before the shuffle, so a node with very many links is one row there, and each round's
    links are written to the shared folder.
    """
    links = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(smallest, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("l"))
            .select("l.*")
            .where("a <> b")
            .distinct()
        )
        links = stored(small, "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
