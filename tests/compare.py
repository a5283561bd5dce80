"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, str(r[i])) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[str | None, int]:
    """A description of the first difference, or None, and the number of rows."""
    got = df.collect()
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    ours, theirs = rows_of(df.columns, got), rows_of(names, want)
    if ours != theirs:
        return f"{len(got)} vs {len(want)} rows; ours {list((ours - theirs).items())[:2]}; sql {list((theirs - ours).items())[:2]}", len(got)
    return None, len(got)
