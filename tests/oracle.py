"""Compares a query with its DuckDB counterpart as sorted, typed rows."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}" if v != int(v) else str(int(v))
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def duck(folder: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got = con.execute(sql)
    return rows([c[0] for c in got.description], got.fetchall())


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])
