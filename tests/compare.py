"""Compare a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """'' when equal, else what differs."""
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    wanted_columns, wanted = rows_of([c[0] for c in result.description], result.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} / {wanted_columns}"
    if got != wanted:
        extra, missing = sorted(set(got) - set(wanted))[:3], sorted(set(wanted) - set(got))[:3]
        return f"{len(got)} / {len(wanted)} rows, only here {extra}, only in SQL {missing}"
    return "" if got else "no rows"
