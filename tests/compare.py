"""Run a registered query and its SQL over one folder and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else float(f"{f:.9g}") if isinstance(v, (float, decimal.Decimal)) else int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def counted(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, query, sql: str, folder: str) -> str:
    df = query(spark, folder)
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    a, b = counted(df.columns, [tuple(r) for r in df.collect()]), counted(rel.columns, rel.fetchall())
    if a != b:
        return f"{sum(a.values())} and {sum(b.values())} rows; only here {list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}"
    return ""
