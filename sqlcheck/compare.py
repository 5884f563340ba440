"""Compare a Spark query with its DuckDB oracle: rows, column names, values.

Values are compared as an order-insensitive multiset after normalising
types the two engines represent differently (int widths, float rounding,
dates, arrays, structs).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import time
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(_norm(x) for x in v.values())
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def compare(spark, con, name: str, spark_fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {
        "query": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "schema_match": sorted(s_cols) == sorted(d_cols),
        "spark_sec": round(t1 - t0, 2),
    }
    if res["schema_match"]:
        a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
        res["value_match"] = a == b
        if a != b:
            res["spark_only"] = list((a - b).elements())[:2]
            res["oracle_only"] = list((b - a).elements())[:2]
    else:
        res["value_match"] = False
        res["spark_cols"] = sorted(set(s_cols) - set(d_cols))
        res["oracle_cols"] = sorted(set(d_cols) - set(s_cols))
    res["ok"] = res["schema_match"] and res["value_match"] and res["spark_rows"] == res["oracle_rows"]
    return res
