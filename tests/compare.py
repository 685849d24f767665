"""Compare a Spark query with its DuckDB text on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when columns and all rows agree, else what differs first."""
    spark_columns, spark_rows = _sorted_rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    duck_columns, duck_rows = _sorted_rows(names, result.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} / {duck_columns}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} / {len(duck_rows)}"
    for ours, theirs in zip(spark_rows, duck_rows):
        if ours != theirs:
            return f"{ours} / {theirs}"
    return None
