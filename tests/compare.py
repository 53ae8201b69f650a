"""Holds a query's rows against its SQL's, as multisets."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.10g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return [cols[k] for k in order], sorted(str([plain(r[k]) for k in order]) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def same(df, con, sql):
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
