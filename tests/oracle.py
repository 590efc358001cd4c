"""Compare a query with its SQL as the driver does: columns by name, rows as a bag."""

from __future__ import annotations

import datetime
import glob
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = Path(f).stem
        where = f"{f}/*.parquet" if Path(f).is_dir() else f
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{where}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    return str(value) if value is not None else None


def bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(con, df, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected, found = bag(names, result.fetchall()), bag(df.columns, df.collect())
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} and {sorted(names)}")
    if expected != found:
        out.append(f"rows {sum(found.values())} and {sum(expected.values())}: more {list((found - expected).items())[:3]}, less {list((expected - found).items())[:3]}")
    return out
