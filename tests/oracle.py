"""Run a query and its SQL on the same tables and compare the rows as bags."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(r[i] for i in order) for r in result.fetchall())


def actual(df) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    return cols, Counter(tuple(r[c] for c in cols) for r in df.collect())


def differences(con, df, sql: str) -> str:
    want_cols, want = expected(con, sql)
    cols, got = actual(df)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if got != want:
        extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows {sum(got.values())} vs {sum(want.values())}\n only spark: {str(extra)[:1500]}\n only sql: {str(lost)[:1500]}"
    return "" if sum(want.values()) else "no rows on either side"
