"""Session settings and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the jobs rely on; cluster sizing stays with whoever starts the session."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster a machine-local
    folder would not be visible to the other executors and would not survive the loss of one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no shared folder; set it before running on a cluster")
    root = tempfile.mkdtemp(prefix="tidewell-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared root; every run gets its own, so nothing has to be cleared first."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: what several later steps read is computed once, and its
    result outlives the executors that computed it."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
