"""Compare a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    result = connection.sql(sql)
    return normal(result.columns, result.fetchall())
