"""Run a query on Spark and its SQL on DuckDB and compare all rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None when names and rows agree, else what differs."""
    spark_rows = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    oracle_rows = rows_of(names, result.fetchall())
    if spark_rows == oracle_rows:
        return None
    extra = list((spark_rows - oracle_rows).items())[:3]
    absent = list((oracle_rows - spark_rows).items())[:3]
    return (
        f"{spark_rows.total()} rows against {oracle_rows.total()}; "
        f"only Spark: {extra}; only SQL: {absent}"
    )
