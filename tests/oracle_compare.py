"""Run a registered query in Spark and its oracle SQL in DuckDB on the same
tables, and compare row count, column names and an order-insensitive hash
of the values (floats to 6 decimals, NULL and NaN kept apart)."""

from __future__ import annotations

import hashlib
import math
from datetime import date, datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return f"b:{v}"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, 6)
        return f"f:{0.0 if r == 0 else r!r}"
    if isinstance(v, int):
        return f"i:{v}"
    if isinstance(v, datetime):
        return f"ts:{v.isoformat()}"
    if isinstance(v, date):
        return f"d:{v.isoformat()}"
    return f"s:{v}"


def table_hash(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, query, sql: str, con=None) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck_connection(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    return {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": sorted(s_cols), "oracle_columns": sorted(d_cols),
        "hash_match": table_hash(s_cols, s_rows) == table_hash(d_cols, d_rows),
        "spark_rows": s_rows, "oracle_rows": d_rows,
        "s_cols": s_cols, "d_cols": d_cols,
    }
