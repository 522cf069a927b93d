"""Catalog work: external tables, listing, create-table-as with reconciliation, schema adaptation, loads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.quality import reconcile
from tidewell.operators.totals import union_labelled


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "orc", schema: T.StructType | str | None = None) -> DataFrame:
    """A named table over files that stay where they are; the partitions found under the path are added."""
    if not spark.catalog.tableExists(name):
        fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        spark.catalog.createTable(name, path=path, source=fmt, schema=fields)
    return spark.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table string, type string, temporary boolean")


def with_parameters(spark: SparkSession, query: str, **values: object) -> DataFrame:
    """A query with named parameters (``:name``) and identifiers (``IDENTIFIER(:name)``)."""
    return spark.sql(query, args=values)


def create_as(spark: SparkSession, name: str, df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Create a table from a query and give back the row counts on both sides with a status."""
    df.writeTo(name).using(fmt).create()
    return reconcile(count_rows({name: spark.table(name)}), count_rows({name: df}))


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables as one DataFrame."""
    return union_labelled({n: df.agg(F.count("*").alias("rows")) for n, df in tables.items()}, "table").select("table", "rows")


def load_and_reconcile(tables: Mapping[str, DataFrame], root: str, expected: DataFrame | None = None) -> DataFrame:
    """Write every table under the root and compare what is there with the expected row counts."""
    spark = next(iter(tables.values())).sparkSession
    written = {}
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")
        written[name] = spark.read.parquet(f"{root}/{name}")
    return reconcile(count_rows(written), count_rows(tables) if expected is None else expected)


def adapt_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast to the target types; columns the target does not name are left out."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def schema_changes(df: DataFrame, target: T.StructType) -> DataFrame:
    """Which columns the adaptation changes, and how many per kind of change."""
    rows = []
    for f in target.fields:
        if f.name not in df.columns:
            rows.append((f.name, "missing", "", f.dataType.simpleString()))
            continue
        have = df.schema[f.name]
        if have.dataType != f.dataType:
            rows.append((f.name, "type", have.dataType.simpleString(), f.dataType.simpleString()))
        if have.nullable != f.nullable:
            rows.append((f.name, "nullable", str(have.nullable), str(f.nullable)))
    rows += [(c, "dropped", df.schema[c].dataType.simpleString(), "") for c in df.columns if c not in target.names]
    return df.sparkSession.createDataFrame(rows, "column string, change string, before string, after string")


def append_partitioned(df: DataFrame, name: str, by: str) -> None:
    """Append to a table partitioned by the value of a column; created on first use."""
    df.write.mode("append").format("parquet").partitionBy(by).saveAsTable(name)
