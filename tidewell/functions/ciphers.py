"""AES column helpers.  Everything runs on Spark's own ``aes_*`` expressions; no Python per row.

Two stored forms are understood:

* tagged     ``enc:v1:`` + base64(IV 16 bytes, then AES-256-CBC with PKCS padding), one key per row
* versioned  ``<key version>:`` + base64(ciphertext), key and fixed IV looked up by version
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions import json_text

# Fixed values of the stored forms.
TAG = "enc:v1:"
VERSIONED = r"^([0-9]+):([A-Za-z0-9+/=]+)$"


def _seal(value: Column, key: Column, iv: Column) -> Column:
    return F.aes_encrypt(value, key, F.lit("CBC"), F.lit("PKCS"), iv)


def _open(blob: Column, key: Column) -> Column:
    return F.aes_decrypt(blob, key, F.lit("CBC"), F.lit("PKCS")).cast("string")


def key_ref(wrapped_key: Column) -> Column:
    """Lookup id of a wrapped data key: a rotated key gets a new id instead of replacing the old one."""
    return F.upper(F.sha2(wrapped_key, 256))


def encrypt_tagged(value: Column, key: Column, iv: Column) -> Column:
    """Text -> tagged form.  Spark writes the given IV in front of the ciphertext."""
    return F.concat(F.lit(TAG), F.base64(_seal(value, key, iv)))


def decrypt_tagged(value: Column, key: Column) -> Column:
    """Tagged form -> text; untagged text passes through.  A wrong key fails the query, it is never hidden."""
    blob = F.unbase64(F.substring(value, F.lit(len(TAG) + 1), F.length(value)))
    plain = _open(blob, key)
    return F.when(F.startswith(value, F.lit(TAG)), plain).otherwise(value)


def decrypt_properties(text: Column, key: Column) -> Column:
    """JSON object of plain and tagged values -> ``map<string,string>`` in plain text."""
    return F.transform_values(json_text.text_map(text), lambda _, v: decrypt_tagged(v, key))


def encrypt_versioned(value: Column, version: Column, key: Column, iv: Column) -> Column:
    """Deterministic form for lookups: the same text, key version and IV always give the same ciphertext."""
    sealed = _seal(value, key, iv)
    body = F.substring(sealed, F.lit(17), F.length(sealed))
    return F.concat(version.cast("string"), F.lit(":"), F.base64(body))


def decrypt_versioned(value: Column, ring: Column) -> Column:
    """Versioned form -> text with ``ring: map<version, struct<key,iv>>``; other text passes through.

    A version the ring does not know fails the query: leaving ciphertext behind would look like success.
    """
    version = F.regexp_extract(value, VERSIONED, 1)
    body = F.unbase64(F.regexp_extract(value, VERSIONED, 2))
    entry = F.try_element_at(ring, version)
    blob = F.concat(entry["iv"], body)
    plain = F.when(entry.isNull(), F.raise_error(F.concat(F.lit("unknown key version "), version))).otherwise(
        _open(blob, entry["key"])
    )
    return F.when(value.rlike(VERSIONED), plain).otherwise(value)


def decrypt_property_map(props: Column, ring: Column, keep: Column) -> Column:
    """Decrypt a ``map<string,string>`` except the names in ``keep``, which stay as stored."""
    kept = F.coalesce(keep, F.array().cast("array<string>"))
    return F.transform_values(
        props, lambda name, v: F.when(F.array_contains(kept, name), v).otherwise(decrypt_versioned(v, ring))
    )
