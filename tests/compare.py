"""Run a query in Spark and its SQL in DuckDB, and compare the rows as sets with counts."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(x):
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float):
        if math.isnan(x):
            return None
        return round(x, 5)
    if hasattr(x, "as_tuple"):
        return round(float(x), 5)
    return x


def _rows(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [[_value(v) for v in table.column(name).to_pylist()] for name in names]
    return names, Counter(zip(*columns))


def differences(df, sql: str, con) -> str | None:
    """None when equal, else a short description."""
    left_names, left = _rows(df.toArrow())
    right_names, right = _rows(con.sql(sql).to_arrow_table())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{sum(left.values())} rows in Spark, {sum(right.values())} in SQL; "
            f"{sum(only_left.values())} only in Spark, e.g. {list(only_left)[:2]}; "
            f"{sum(only_right.values())} only in SQL, e.g. {list(only_right)[:2]}"
        )
    return None
