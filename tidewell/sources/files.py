"""Files in an object store: CSV, TSV, JSON lines and Parquet, by path or glob, and exports read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str


# Escapes of text cells, the backslash first, and what stands for NULL.
_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
_NULL = "\\N"


def _escaped(text: Column) -> Column:
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.coalesce(text, F.lit(_NULL))


def _unescaped(raw: Column) -> Column:
    """Cut at doubled backslashes first: what is left between them holds single escapes only."""

    def plain(part: Column) -> Column:
        for character, escaped in _ESCAPES[1:]:
            part = F.replace(part, F.lit(escaped), F.lit(character))
        return part

    whole = F.array_join(F.transform(F.split(raw, r"\\\\", -1), plain), "\\")
    return F.when(raw != _NULL, whole)


def _fields(schema: Schema) -> list[T.StructField]:
    return (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields


def read_csv(
    spark: SparkSession, path: str | list[str], schema: Schema, name_glob: str | None = None, escaped: bool = True
) -> DataFrame:
    """CSV with a header line.  The schema is given: inference would read everything twice.

    ``escaped`` is for files of :func:`write_csv`, whose text cells tell NULL from empty text and hold no line ends;
    without it cells are taken as they are and an empty one is NULL.
    """
    fields = _fields(schema)
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"')
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob).option("recursiveFileLookup", True)
    if not escaped:
        return reader.schema(T.StructType(fields)).csv(path)
    rows = reader.option("nullValue", _NULL).option("emptyValue", "").schema(T.StructType(fields)).csv(path)
    return rows.select(*[_unescaped(F.col(f"`{f.name}`")).alias(f.name) if f.dataType == T.StringType() else F.col(f"`{f.name}`") for f in fields])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line and quoted cells.  In text, backslash, tab and line ends are escaped, so a row is a line and
    files can be split; NULL is ``\\N`` and differs from empty text."""
    text = [f.name for f in df.schema.fields if f.dataType == T.StringType()]
    out = df.select(*[_escaped(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`") for c in df.columns])
    writer = out.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True)
    writer.option("nullValue", _NULL).option("emptyValue", "").csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text: NULL as ``\\N``; tab, line ends and backslash escaped, so one row is one line."""
    cells = [_escaped(F.col(f"`{c}`").cast("string")) for c in df.columns]
    df.select(F.concat_ws("\t", *cells).alias("value")).write.mode("overwrite").text(path)


def read_tsv(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    cells = F.split("value", "\t", -1)
    columns = [_unescaped(F.get(cells, F.lit(i))).cast(f.dataType).alias(f.name) for i, f in enumerate(_fields(schema))]
    return spark.read.text(path).select(*columns)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: Schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """JSON lines; with ``by`` one set of files per value, for instance one per partition id."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(*by) if by else writer).json(path)


def split_good_and_bad(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Lines that parse, and the text of those that do not; a bad line never stops a load."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = spark.read.text(path).select(
        "value",
        F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"),
    )
    bad = F.col("r._corrupt_record").isNotNull() | F.col("r").isNull()
    return parsed.where(~bad).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields]), parsed.where(bad).select(
        F.col("value").alias("record")
    )


def write_processed(df: DataFrame, path: str, doubled: str) -> None:
    """Parquet copy with a derived value and the time of processing."""
    df.withColumn(doubled, F.col(doubled) * 2).withColumn("processed_at", F.current_timestamp()).write.mode(
        "overwrite"
    ).parquet(path)


def export(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None) -> DataFrame:
    """Write a result and give back the same rows read from the files."""
    out = df.coalesce(files) if files else df
    if fmt == "csv":
        write_csv(out, path)
        return read_csv(df.sparkSession, path, df.schema)
    if fmt == "tsv":
        write_tsv(out, path)
        return read_tsv(df.sparkSession, path, df.schema)
    out.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)
