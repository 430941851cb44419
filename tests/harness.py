"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return "-0.0" if value == 0 and math.copysign(1, value) < 0 else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted_rows(df.columns, df.collect())


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    return sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(ours, theirs) -> str | None:
    """None when equal, else a short account of what differs."""
    (columns, rows), (other_columns, other_rows) = ours, theirs
    if columns != other_columns:
        return f"columns {columns} / {other_columns}"
    if rows == other_rows:
        return None
    left, right = [r for r in rows if r not in set(other_rows)], [r for r in other_rows if r not in set(rows)]
    return f"{len(rows)} / {len(other_rows)} rows; only Spark {left[:3]}; only DuckDB {right[:3]}"
