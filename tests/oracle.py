"""Run a registered query on Spark and its SQL twin on DuckDB and compare the rows."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("num", float(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("num", "nan" if math.isnan(v) else float(f"{v:.12g}"))
    if isinstance(v, datetime.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, datetime.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(plain(x) for x in v))
    if isinstance(v, dict):
        return ("map", tuple(sorted((k, plain(x)) for k, x in v.items())))
    return ("other", str(v) if v is not None else "\\N")


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    names = sorted(cols)
    at = [cols.index(n) for n in names]
    return names, sorted(repr(tuple(plain(r[i]) for i in at)) for r in cur.fetchall())


def compare(df, con, sql):
    sn, sr = spark_rows(df)
    dn, dr = duck_rows(con, sql)
    if sn != dn:
        return f"columns {sn} != {dn}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}\n  spark {sr[:2]}\n  duck  {dr[:2]}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return f"{len(bad)} of {len(sr)} rows differ\n  spark {bad[0][0]}\n  duck  {bad[0][1]}"
    return f"ok {len(sr)}" if sr else "EMPTY"
