"""Encrypted customers: row keys, property objects, versioned key ring, lookups, increments that wait for keys."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import ciphers
from tidewell.operators import keys as K
from tidewell.operators.current import latest
from tidewell.plans import secure_feed
from tidewell.suite.base import query, table
from tidewell.workspace import scratch


def unwrap(wrapped: list[str]) -> list[str]:
    """Stands in for the key service: the data key of a wrapped key."""
    return [hashlib.sha256(("data key of " + w).encode()).hexdigest() for w in wrapped]


def _key_of(edk):
    return F.unhex(F.sha2(F.concat(F.lit("data key of "), edk).cast("binary"), 256))


def _iv(text):
    return F.unhex(F.md5(text.cast("binary")))


def encrypted_users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as they arrive: tenant keys, and a rotated key with a new version for every 10th one."""
    c = table(spark, sf, "customer")
    tenant = F.concat(F.lit("t"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))

    def version(n: int, month: int) -> DataFrame:
        edk = F.concat(F.lit(f"wrapped-{n}-"), tenant)
        seal = lambda v, salt: ciphers.encrypt_tagged(v, _key_of(edk), _iv(F.concat(F.col("c_name"), F.lit(salt))))
        name = F.col("c_name") if n == 0 else F.concat(F.col("c_name"), F.lit("-new"))
        props = F.to_json(
            F.struct(
                F.col("c_mktsegment").alias("plan"),
                F.col("c_nationkey").alias("visits"),
                (F.col("c_nationkey") > 10).alias("optIn"),
                seal(name, "n").alias("name"),
                seal(F.concat(F.lit("메모 "), F.col("c_custkey").cast("string")), "m").alias("memo"),
            )
        )
        return c.select(
            F.col("c_custkey").alias("user_id"),
            tenant.alias("tenant_id"),
            edk.alias("edk"),
            seal(F.concat(F.lower("c_name"), F.lit("@example.com")), "e").alias("email_enc"),
            seal(F.concat(F.lit("010-"), F.col("c_custkey").cast("string")), "p").alias("phone_enc"),
            props.alias("properties"),
            F.lit(n).cast("bigint").alias("_version"),
            F.lit(0).alias("_is_deleted"),
            F.timestamp_seconds(
                F.unix_timestamp(F.to_timestamp(F.lit(f"2024-{month:02d}-01"))) + F.col("c_custkey") % 86400
            ).cast("timestamp_ntz").alias("_synced_at"),
        )

    return version(0, 1).unionByName(version(1, 2).where(F.col("user_id") % 10 == 0))


USERS_SQL = """users AS (
  SELECT c_custkey AS user_id, 't' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS tenant_id,
         lower(c_name) || '@example.com' AS email, '010-' || c_custkey AS phone, c_mktsegment AS plan, c_nationkey AS visits,
         c_name AS name FROM customer)"""


@query(
    "crypto_decrypt",
    f"WITH {USERS_SQL} SELECT user_id, email, phone FROM users UNION ALL SELECT user_id, email, phone FROM users WHERE user_id % 10 = 0",
)
def crypto_decrypt(spark, sf):
    """Every stored version with the key of its row; keys are unwrapped once per distinct wrapped key."""
    log = encrypted_users(spark, sf)
    opened = K.decrypt_rows(log, "edk", K.unwrap_keys(log, "edk", unwrap), secure_feed.VALUES, {})
    return opened.select("user_id", "email", "phone")


@query(
    "crypto_props",
    f"""WITH {USERS_SQL} SELECT user_id, plan, CAST(visits AS VARCHAR) AS visits, CASE WHEN visits > 10 THEN 'true' ELSE 'false' END AS opt_in,
          CASE WHEN user_id % 10 = 0 THEN name || '-new' ELSE name END AS name, '메모 ' || user_id AS memo FROM users""",
)
def crypto_props(spark, sf):
    """The newest version of each user, property objects decrypted to text values."""
    log = encrypted_users(spark, sf)
    opened = secure_feed.backfill(log, K.unwrap_keys(log, "edk", unwrap))
    p = F.col("properties")
    return opened.select(
        "user_id", p["plan"].alias("plan"), p["visits"].alias("visits"), p["optIn"].alias("opt_in"), p["name"].alias("name"), p["memo"].alias("memo")
    )


@query(
    "crypto_follow",
    f"""WITH {USERS_SQL} SELECT user_id, CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS version, email FROM users""",
)
def crypto_follow(spark, sf):
    """Two increments: rotated keys are unknown in the first one, their rows wait and are taken by the second."""
    root = scratch(spark, "follow")
    encrypted_users(spark, sf).write.parquet(f"{root}/log")
    log = spark.read.parquet(f"{root}/log")
    K.unwrap_keys(log, "edk", unwrap).write.parquet(f"{root}/keys")
    everything = spark.read.parquet(f"{root}/keys")
    early = log.where("_version = 0").select(ciphers.key_ref(F.col("edk").cast("binary")).alias("key_ref")).distinct()
    known = everything.join(early, "key_ref", "left_semi")
    empty = K.decrypt_rows(log.where("false"), "edk", known, secure_feed.VALUES, secure_feed.PROPERTIES)
    first, waiting = secure_feed.follow(log, empty, log.where("false"), known)
    first.write.parquet(f"{root}/target")
    waiting.write.parquet(f"{root}/pending")
    held, pending = spark.read.parquet(f"{root}/target"), spark.read.parquet(f"{root}/pending")
    second, _ = secure_feed.follow(log, held, pending, everything)
    second.write.mode("append").parquet(f"{root}/target")
    state = latest(spark.read.parquet(f"{root}/target"), ["user_id"], "_version", "_is_deleted")
    return state.select("user_id", F.col("_version").cast("int").alias("version"), "email")


# --- versioned key ring --------------------------------------------------------------------------------------


def key_ring(spark: SparkSession) -> DataFrame:
    rows = []
    for column in ("props", "email"):
        for version in (1, 2):
            digest = hashlib.sha256(f"{column} {version}".encode()).hexdigest()
            rows.append((column, str(version), digest, digest[:32]))
    return spark.createDataFrame(rows, "column_name string, version string, key_hex string, iv_hex string")


def ring_users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose values are stored as ``<version>:<base64>``; every 4th one under the newer keys."""
    ring = {(r.column_name, r.version): r for r in key_ring(spark).collect()}
    version = F.when(F.col("c_custkey") % 4 == 0, "2").otherwise("1")

    def seal(value, column):
        one = lambda v: ciphers.encrypt_versioned(
            value, F.lit(v), F.unhex(F.lit(ring[column, v].key_hex)), F.unhex(F.lit(ring[column, v].iv_hex))
        )
        return F.when(F.col("c_custkey") % 4 == 0, one("2")).otherwise(one("1"))

    props = F.to_json(
        F.struct(
            seal(F.col("c_mktsegment"), "props").alias("plan"),
            seal(F.col("c_nationkey").cast("string"), "props").alias("visits"),
            seal(F.concat(F.lit("name "), (F.col("c_custkey") % 6).cast("string")), "props").alias("name"),
            F.lit("plain").alias("note"),
        )
    )
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("t"), F.lpad((F.col("c_custkey") % 8).cast("string"), 3, "0")).alias("tenant_id"),
        seal(F.concat(F.lower("c_name"), F.lit("@example.com")), "email").alias("encrypted_email"),
        props.alias("encrypted_properties"),
        version.alias("stored_version"),
    )


def _keep(spark: SparkSession) -> DataFrame:
    """Even tenants keep the name encrypted."""
    return spark.createDataFrame([(f"t{i:03d}", ["name"]) for i in range(0, 8, 2)], "tenant_id string, keep array<string>")


def _opened(spark: SparkSession, sf: str) -> DataFrame:
    return secure_feed.open_properties(ring_users(spark, sf), key_ring(spark), _keep(spark), "encrypted_properties", "props")


@query(
    "crypto_keyring",
    """SELECT c_custkey AS user_id, c_mktsegment AS plan, CAST(c_nationkey AS VARCHAR) AS visits,
              CASE WHEN c_custkey % 8 % 2 = 0 THEN 'kept' ELSE 'name ' || (c_custkey % 6) END AS name, 'plain' AS note FROM customer""",
)
def crypto_keyring(spark, sf):
    p = F.col("props")
    name = F.when(p["name"].rlike(ciphers.VERSIONED), "kept").otherwise(p["name"])
    return _opened(spark, sf).select(
        "user_id", p["plan"].alias("plan"), p["visits"].alias("visits"), name.alias("name"), p["note"].alias("note")
    )


@query(
    "crypto_lookup",
    """WITH c AS (SELECT c_custkey, c_mktsegment, c_nationkey, c_custkey % 6 = 2 AS hit, c_custkey % 2 = 0 AS kept FROM customer)
       SELECT 'email, all versions' AS q, count(*) FILTER (WHERE c_custkey IN (8, 9)) AS users FROM c UNION ALL
       SELECT 'email, version 1 only', count(*) FILTER (WHERE c_custkey IN (8, 9) AND c_custkey % 4 <> 0) FROM c UNION ALL
       SELECT 'name =', count(*) FILTER (WHERE hit AND kept) FROM c UNION ALL
       SELECT 'name <>', count(*) FILTER (WHERE kept AND NOT hit) FROM c UNION ALL
       SELECT 'plain next to it', count(*) FILTER (WHERE c_mktsegment = 'BUILDING' AND c_nationkey >= 10) FROM c""",
)
def crypto_lookup(spark, sf):
    """Equality on ciphertext over all key versions, the negation, and a plain condition beside it."""
    ring, users = key_ring(spark), ring_users(spark, sf)
    wanted = users.where(F.col("user_id").isin(8, 9)).select(
        F.concat(F.lit("customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"), F.lit("@example.com")).alias("v")
    )
    emails = K.ciphertexts(ring, "email", wanted, "v")
    kept = _opened(spark, sf).where(F.col("user_id") % 2 == 0).withColumn("name", F.col("props")["name"])
    names = K.ciphertexts(ring, "props", spark.createDataFrame([("name 2",)], "v string"), "v")
    plain = _opened(spark, sf).where(
        (F.col("props")["plan"] == "BUILDING") & (F.coalesce(F.col("props")["visits"].try_cast("int"), F.lit(0)) >= 10)
    )
    counts = {
        "email, all versions": K.find_by_ciphertext(users, "encrypted_email", emails),
        "email, version 1 only": K.find_by_ciphertext(users, "encrypted_email", emails.where("version = '1'")),
        "name =": K.find_by_ciphertext(kept, "name", names),
        "name <>": K.all_but_ciphertext(kept, "name", names),
        "plain next to it": plain,
    }
    out = None
    for name, df in counts.items():
        part = df.agg(F.count("*").alias("users")).withColumn("q", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("crypto_batched_calls", "SELECT c_custkey, upper(c_name) || '/' || c_nationkey AS answer FROM customer")
def crypto_batched_calls(spark, sf):
    """Rows sent to a service in ordered batches; every batch fails on its first try and is sent again."""
    tried: set = set()

    def client(rows):
        mark = (len(rows), rows["c_custkey"].iloc[0])
        if mark not in tried:
            tried.add(mark)
            raise ConnectionError("try again")
        return [f"{n.upper()}/{k}" for n, k in zip(rows["c_name"], rows["c_nationkey"])]

    called = K.call_in_batches(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"),
        ["c_custkey", "c_name", "c_nationkey"],
        "answer",
        client,
        batch_rows=500,
        pause_seconds=0.01,
    )
    return called.select("c_custkey", "answer")


@query(
    "crypto_lookup_stored",
    """SELECT c_custkey AS user_id, 'customer#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '@example.com' AS email, TRUE AS few_files
       FROM customer WHERE c_custkey IN (8, 9, 30)""",
)
def crypto_lookup_stored(spark, sf):
    """Three addresses looked for by their stored ciphertexts under all key versions, in files sorted by these; the
    predicate's constants can be in at most one file each."""
    ring, path = key_ring(spark), scratch(spark, "stored-ciphertext")
    K.store_for_lookup(ring_users(spark, sf).select("user_id", "encrypted_email"), path, "encrypted_email")
    held = spark.read.parquet(path)
    emails = [f"customer#{n:09d}@example.com" for n in (8, 9, 30)]
    found = K.find_stored(held, "encrypted_email", ring, "email", emails)
    plain = ciphers.decrypt_versioned(F.col("encrypted_email"), K.ring_of(ring, "email"))
    spans = held.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("encrypted_email").alias("lo"), F.max("encrypted_email").alias("hi"))
    asked = K.ciphertexts(ring, "email", spark.createDataFrame([(e,) for e in emails], "v string"), "v")
    per_text = asked.join(spans, F.col("ciphertext").between(F.col("lo"), F.col("hi"))).groupBy("ciphertext").agg(F.count("*").alias("n"))
    few = per_text.agg(F.coalesce(F.max("n") <= 1, F.lit(True)).alias("few")).scalar()
    return found.select("user_id", plain.alias("email"), few.alias("few_files"))
