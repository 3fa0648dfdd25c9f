"""Run a named plan in Spark and its oracle SQL in DuckDB and compare the
results as the driver does: row count, column names, and an order-insensitive
hash of the values (columns sorted by name)."""

from __future__ import annotations

import hashlib

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and pd.isna(v)):
        return "∅"
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    if isinstance(v, float):
        return repr(v)
    return str(v)


def digest(rows: list[tuple], columns: list[str]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out = {
        "name": name,
        "rows": (len(s_rows), len(d_rows)),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": digest(s_rows, s_cols) == digest(d_rows, d_cols),
    }
    out["ok"] = out["rows"][0] == out["rows"][1] and out["cols_match"] and out["hash_match"]
    if not out["cols_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    return out
