"""Local Spark-vs-DuckDB parity harness (mirrors the driver's check).

Compares row count, column names and an order-insensitive value digest.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()]
    rows.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return cols, rows


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    cs, rs = canon(s)
    cd, rd = canon(d)
    if rs != rd:
        diffs = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        return False, f"values differ, first diffs: {diffs}"
    return True, "ok"
