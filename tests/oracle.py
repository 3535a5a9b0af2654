"""Local stand-in for the driver's correctness gate: run a catalogue query
in Spark and its SQL in DuckDB over the same parquet tables, then compare
column names, row count and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(spark_df, con, sql: str) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = spark_df.collect()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not res["columns_match"]:
        res["spark_only"] = sorted(set(s_cols) - set(d_cols))
        res["oracle_only"] = sorted(set(d_cols) - set(s_cols))
        res["match"] = False
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = Counter(repr(tuple(_norm(r[i]) for i in si)) for r in s_rows)
    b = Counter(repr(tuple(_norm(r[i]) for i in di)) for r in d_rows)
    res["match"] = a == b
    if not res["match"]:
        res["spark_extra"] = list((a - b).elements())[:3]
        res["oracle_extra"] = list((b - a).elements())[:3]
    return res
