"""Compare queries with their DuckDB oracle: names, types, rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(frame, relation) -> list[str]:
    found = []
    spark_types = {name: SPARK_TYPES.get(kind, kind) for name, kind in frame.dtypes}
    duck_types = {name: str(kind) for name, kind in zip(relation.columns, relation.types, strict=True)}
    if spark_types != duck_types:
        found.append(f"columns {spark_types} vs {duck_types}")
        if spark_types.keys() != duck_types.keys():
            return found
    order = sorted(spark_types)
    at = [relation.columns.index(n) for n in order]
    left = Counter(tuple(plain(r[n]) for n in order) for r in frame.collect())
    right = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    if left != right:
        extra, missing = left - right, right - left
        found.append(
            f"rows {left.total()} vs {right.total()}; only Spark {list(extra)[:3]}; only SQL {list(missing)[:3]}; columns {order}"
        )
    return found
