"""Compare registered queries with their SQL: columns by name, rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from modelweave.sources.star_sql import STAR_TABLES


def connect(folder: str):
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple((type(r[i]).__name__, _norm(r[i])) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, else a short description."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, missing = got - want, want - got
        return (f"spark {sum(got.values())} rows, sql {sum(want.values())} rows; only spark"
                f" {list(extra.items())[:2]}; only sql {list(missing.items())[:2]}")
    return None
