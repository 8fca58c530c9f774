"""Rows of Spark and DuckDB results in a comparable form."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return (
        [columns[n] for n in order],
        Counter(tuple(_plain(row[n]) for n in order) for row in rows),
    )


def rows_of_spark(df: DataFrame):
    return _sorted_rows(df.columns, df.collect())


def rows_of_duckdb(db, sql: str):
    result = db.execute(sql)
    columns = [column[0] for column in result.description]
    return _sorted_rows(columns, result.fetchall())
