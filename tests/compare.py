"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql):
    """``(columns only in one side, rows only in Spark, rows only in DuckDB, rows)``"""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = bag(names, cursor.fetchall())
    found = bag(spark_df.columns, spark_df.collect())
    return set(names) ^ set(spark_df.columns), found - expected, expected - found, sum(found.values())
