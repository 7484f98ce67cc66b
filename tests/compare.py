"""Compares a registered query with its DuckDB SQL on one data folder."""

from __future__ import annotations

import glob
import math
import os

import duckdb

REL = 1e-9


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("", "")
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, (int, float)):
        return ("n", f"{float(v):.9g}")
    return (type(v).__name__, str(v))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    got = table(df.columns, [tuple(r) for r in df.collect()])
    want = table(*sql_rows(con, sql))
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return "first difference: " + str([(n, x, y) for n, x, y in zip(got[0], a, b) if x != y])
    return None
