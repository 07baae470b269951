"""Runs a query in Spark and its SQL in DuckDB and compares names, row counts and values."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return ("d", f"{value.normalize():f}")
    if isinstance(value, float):
        return ("n",) if math.isnan(value) else ("f", f"{value:.9g}")
    return (type(value).__name__, str(value))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short report."""
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = rows_of(want_names, result.fetchall())
    if sorted(want_names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(want_names)}"
    got = rows_of(spark_df.columns, spark_df.collect())
    if got == want:
        return None
    extra, missing = [r for r in got if r not in set(want)], [r for r in want if r not in set(got)]
    return f"{len(got)} rows instead of {len(want)}; extra {extra[:2]}; missing {missing[:2]}"
