"""Run a catalog query and its SQL side by side and compare all rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def _normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def _rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_normal(r[i]) for i in order) for r in records)


def duckdb_tables(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql: str) -> str:
    """Empty when both sides hold the same columns and the same multiset of rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(result.fetchall(), names)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    if got == want:
        return ""
    extra = [r for r in got if r not in set(want)][:3]
    lost = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows, expected {len(want)}; only here {extra}; only there {lost}"
