"""Compare a registered Spark query with its DuckDB oracle like the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(data_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, name: str, fn, sql: str, data_dir: str) -> dict:
    df = fn(spark, data_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = duck(data_dir).sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    out["values_match"] = out["columns_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not out["values_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        if out["columns_match"]:
            sm = {tuple(_norm(r[s_cols.index(c)]) for c in sorted(s_cols)) for r in s_rows}
            dm = {tuple(_norm(r[d_cols.index(c)]) for c in sorted(d_cols)) for r in d_rows}
            out["only_spark"] = sorted(sm - dm, key=str)[:3]
            out["only_oracle"] = sorted(dm - sm, key=str)[:3]
    return out
