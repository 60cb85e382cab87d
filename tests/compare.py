"""Running a query in Spark and its SQL in DuckDB, and comparing the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

from registry.base import TABLES


def database(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, Decimal):
        return v.normalize()
    if isinstance(v, date) and not isinstance(v, datetime):
        return v.isoformat()
    return v


def _rows(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides have the same columns and the same bag of rows."""
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = _rows(cur.fetchall(), want_names)
    got = _rows([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if sorted(want_names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_names)}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows vs {sum(want.values())}; only here {extra}; only there {missing}"
    return None
