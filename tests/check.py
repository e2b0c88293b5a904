"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if hasattr(v, "toArray"):
        v = v.toArray().tolist()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


#: Types that must agree; others (lists, decimals) are compared by value only.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def difference(df, con, sql: str) -> str | None:
    """None when equal; else a description of the difference."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    described = rel.description
    want_cols, want = rows_of([d[0] for d in described], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    theirs = {d[0]: str(d[1]) for d in described}
    odd = [
        (c, t, theirs[c]) for c, t in df.dtypes
        if t in TYPES and theirs[c] in {*TYPES.values(), "HUGEINT"} and TYPES[t] != theirs[c]
    ]
    if odd:
        return f"types {odd}"
    if got != want:
        only_got, only_want = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"only ours {sum(only_got.values())}: {list(only_got)[:3]}; "
            f"only sql {sum(only_want.values())}: {list(only_want)[:3]}"
        )
    return None
