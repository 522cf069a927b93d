"""From an encrypted change log to a serving table in plain text, batch and incremental."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ciphers, json_text
from tidewell.operators.current import increment_with_keys, latest
from tidewell.operators.keys import decrypt_rows, ring_of

VALUES = {"email_enc": "email", "phone_enc": "phone"}
PROPERTIES = {"properties": "properties"}
KEYS, VERSION, DELETED, ARRIVED = ["user_id"], "_version", "_is_deleted", "_synced_at"


def backfill(
    log: DataFrame, key_table: DataFrame, values: Mapping[str, str] = VALUES, properties: Mapping[str, str] = PROPERTIES
) -> DataFrame:
    """Decrypt the current state of the change log.

    Only the newest version of a row is decrypted; deleted rows stay in, marked, so a later version still wins over them.
    """
    return decrypt_rows(latest(log, KEYS, VERSION), "edk", key_table, dict(values), dict(properties))


def follow(
    log: DataFrame,
    target: DataFrame,
    pending: DataFrame,
    key_table: DataFrame,
    values: Mapping[str, str] = VALUES,
    properties: Mapping[str, str] = PROPERTIES,
    overlap: str = "1 minute",
) -> tuple[DataFrame, DataFrame]:
    """One increment: (decrypted rows to append, raw rows that wait for their key)."""
    with_ref = log.withColumn("key_ref", ciphers.key_ref(F.col("edk").cast("binary")))
    ready, waiting = increment_with_keys(
        with_ref,
        target,
        pending.withColumn("key_ref", ciphers.key_ref(F.col("edk").cast("binary"))),
        key_table,
        "key_ref",
        [*KEYS, VERSION],
        ARRIVED,
        overlap,
    )
    decrypted = decrypt_rows(ready.select(*log.columns), "edk", key_table, dict(values), dict(properties))
    return decrypted, waiting.select(*log.columns)


def open_properties(log: DataFrame, ring: DataFrame, keep: DataFrame, stored: str, plain: str) -> DataFrame:
    """Decrypt a property object with the versioned key ring, except what the tenant keeps encrypted.

    ``keep`` has one row per tenant: (tenant_id, keep array<string>).
    """
    joined = log.join(keep, "tenant_id", "left").withColumn("_ring", ring_of(ring, "props"))
    opened = ciphers.decrypt_property_map(json_text.text_map(F.col(stored)), F.col("_ring"), F.col("keep"))
    return json_text.once(joined, {plain: opened}).drop(stored, "keep", "_ring")
