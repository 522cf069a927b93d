"""Key tables and external calls: unwrap each distinct key once, send rows in checked batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ciphers
from tidewell.sources import lake


def unwrap_keys(rows: DataFrame, wrapped: str, unwrap: Callable[[Sequence[str]], Sequence[str]]) -> DataFrame:
    """(key_ref, key_hex) for every distinct wrapped key.

    ``unwrap`` gets a list of wrapped keys and gives the keys as hex, in order; it is called once per distinct key, not
    once per row.  NULL and empty entries are rows without a key and are left out.
    """
    distinct = rows.select(F.col(wrapped).alias("wrapped")).where(F.length("wrapped") > 0).distinct()

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"wrapped": batch["wrapped"], "key_hex": list(unwrap(batch["wrapped"].tolist()))})

    unwrapped = distinct.mapInPandas(calls, "wrapped string, key_hex string")
    return unwrapped.select(ciphers.key_ref(F.col("wrapped").cast("binary")).alias("key_ref"), "key_hex")


def with_key(rows: DataFrame, wrapped: str, key_table: DataFrame, how: str = "inner") -> DataFrame:
    """Join each row with its key as binary column ``_key``; ``inner`` leaves out rows whose key is unknown."""
    table = key_table.select("key_ref", F.unhex("key_hex").alias("_key"))
    return rows.withColumn("key_ref", ciphers.key_ref(F.col(wrapped).cast("binary"))).join(table, "key_ref", how)


def decrypt_rows(
    rows: DataFrame, wrapped: str, key_table: DataFrame, values: dict[str, str], properties: dict[str, str]
) -> DataFrame:
    """Decrypt tagged columns and property objects with the row's own key.

    ``values`` and ``properties`` map an encrypted column to the name of its plain column.  Rows with an unknown
    key are left out; see :func:`tidewell.operators.current.increment_with_keys` for keeping them.
    """
    keyed = with_key(rows, wrapped, key_table)
    plain = [c for c in rows.columns if c not in values and c not in properties and c != wrapped]
    return keyed.select(
        *plain,
        *[ciphers.decrypt_tagged(F.col(c), F.col("_key")).alias(n) for c, n in values.items()],
        *[ciphers.decrypt_properties(F.col(c), F.col("_key")).alias(n) for c, n in properties.items()],
    )


def ring_of(ring: DataFrame, column: str) -> Column:
    """The key ring of one column as ``map<version, struct<key,iv>>``.

    ``ring`` has one row per column and key version (column_name, version, key_hex, iv_hex): it is the configuration of
    the service and grows by one row per rotation.  It is read as a scalar subquery, so no key is written into
    the plan.
    """
    entry = F.struct(
        F.col("version").cast("string").alias("version"),
        F.struct(F.unhex("key_hex").alias("key"), F.unhex("iv_hex").alias("iv")).alias("e"),
    )
    return (
        ring.where(F.col("column_name") == column)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("ring"))
        .scalar()
    )


def ciphertexts(ring: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """Every ciphertext a value may be stored as, one per key version: what an equality lookup has to match.

    ``values`` is a one-column table of search values; the ring rows are carried along as an array and exploded, so
    the result has exactly values x versions rows.
    """
    versions = (
        ring.where(F.col("column_name") == column)
        .agg(F.collect_list(F.struct("version", "key_hex", "iv_hex")).alias("v"))
        .scalar()
    )
    return (
        values.withColumn("_v", F.explode(versions))
        .select(
            F.col(value),
            F.col("_v.version").alias("version"),
            ciphers.encrypt_versioned(
                F.col(value), F.col("_v.version"), F.unhex("_v.key_hex"), F.unhex("_v.iv_hex")
            ).alias("ciphertext"),
        )
    )


def find_by_ciphertext(df: DataFrame, column: str, search: DataFrame) -> DataFrame:
    """Rows whose stored ciphertext is one of the searched ones."""
    return df.join(search.select(F.col("ciphertext").alias(column)).distinct(), column, "left_semi").select(*df.columns)


def store_for_lookup(df: DataFrame, path: str, column: str, rows_per_file: int = 5_000_000) -> None:
    """Write the rows sorted by a stored ciphertext, with Parquet Bloom filters on it: an equality skips files and row
    groups by least and greatest value, and by the filter where the value falls between them."""
    lake.export_sorted(df, path, column, rows_per_file, bloom=[column])


def find_stored(df: DataFrame, column: str, ring: DataFrame, key_column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose stored ciphertext is one of the given texts under any key version.

    The predicate is a list of constants, one for each text and key version, so it reaches the scan; a join would not.
    For more texts than a person types use :func:`find_by_ciphertext`.
    """
    spark = df.sparkSession
    search = ciphertexts(ring, key_column, spark.createDataFrame([(v,) for v in values], "v string"), "v")
    return df.where(F.col(column).isin([r.ciphertext for r in search.select("ciphertext").collect()]))


def all_but_ciphertext(df: DataFrame, column: str, search: DataFrame) -> DataFrame:
    """Rows whose stored ciphertext is none of the searched ones; NULL matches neither, as with ``<>``."""
    known = df.where(F.col(column).isNotNull())
    return known.join(search.select(F.col("ciphertext").alias(column)).distinct(), column, "left_anti").select(*df.columns)


class CallRefused(Exception):
    """The service refused the caller (credentials); trying again is pointless."""


def call_in_batches(
    df: DataFrame,
    columns: Sequence[str],
    result: str,
    client: Callable[[pd.DataFrame], Sequence[str]],
    batch_rows: int = 500,
    attempts: int = 3,
    pause_seconds: float = 0.5,
) -> DataFrame:
    """Add a text column computed by an external service.

    Rows go out in batches in their order; an answer of another length is an error.  A refused call fails at once,
    anything else is tried ``attempts`` times and then fails the task, so nothing is half written.
    """
    names = list(columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{result}` string"

    def one_call(part: pd.DataFrame) -> list[str]:
        problem: Exception | None = None
        for attempt in range(1, attempts + 1):
            try:
                answer = list(client(part[names]))
                if len(answer) != len(part):
                    raise ValueError(f"service gave {len(answer)} rows for {len(part)}")
                return answer
            except CallRefused:
                raise
            except Exception as error:  # noqa: BLE001 - whatever the client raises is worth another try
                problem = error
                if attempt < attempts:
                    time.sleep(pause_seconds * attempt)
        raise RuntimeError(f"service failed after {attempts} attempts: {problem}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers: list[str] = []
            for start in range(0, len(batch), batch_rows):
                answers.extend(one_call(batch.iloc[start : start + batch_rows]))
            yield batch.assign(**{result: answers})

    return df.mapInPandas(run, schema)
