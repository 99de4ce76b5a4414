"""Run a query and its SQL over the same tables and compare the rows, whatever their order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or isinstance(x, (bool, str, bytes)):
        return x
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if hasattr(x, "isoformat"):
        return x.isoformat().replace("T00:00:00", "")
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def differences(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if both give the same columns and rows."""
    df = query(spark, sf_dir)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    expected = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return ""
    a, b = set(map(repr, got)) - set(map(repr, expected)), set(map(repr, expected)) - set(map(repr, got))
    return f"{len(got)} and {len(expected)} rows; only here {sorted(a)[:2]}, only in SQL {sorted(b)[:2]}"
