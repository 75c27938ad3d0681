"""Class tables of the catalog, kept up to date with the lake by the loads.

A table names the folder of a class and knows its partitions. A load adds the leaves it
wrote, which are found by listing the tenant's days for the one batch; nothing else is
listed, then or by a reader that asks for some days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from auditlake.functions.sqltext import ident, literal
from auditlake.sources.lake import BATCH_KEY, PARTITION_KEYS, Tenant

# Partitions named in one statement.
AT_ONCE = 200


def table_name(database: str, table: str) -> str:
    return f"{ident(database)}.{ident(table)}"


def ensure_table(spark: SparkSession, database: str, table: str, path: str, record: T.StructType) -> None:
    """Name a lake folder as a table with its partition keys; no data moves and nothing is
    listed. A table that is there stays as it is."""
    keys = [*PARTITION_KEYS, BATCH_KEY]
    fields = [f for f in record.fields if f.name not in keys] + [T.StructField(k, T.StringType()) for k in keys]
    columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in fields)
    by = ", ".join(ident(k) for k in keys)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(database)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name(database, table)} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION {literal(path)}")


def leaves_of(spark: SparkSession, path: str, tenant: Tenant, batch: str) -> list[str]:
    """Days for which a batch has a leaf in a lake folder."""
    jvm = spark.sparkContext._jvm
    quoted = "".join(f"\\{c}" if c in "\\*?[]{}," else c for c in batch)
    pattern = jvm.org.apache.hadoop.fs.Path(
        f"{path.rstrip('/')}/region={tenant.region}/accountId={tenant.account_id}/eventDay=*/{BATCH_KEY}={quoted}"
    )
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(s.getPath().getParent().getName().removeprefix("eventDay=") for s in found or [])


def add_leaves(spark: SparkSession, database: str, table: str, tenant: Tenant, days: Sequence[str], batch: str) -> None:
    """Make the leaves of a batch known to a table; those it knows stay as they are."""
    for low in range(0, len(days), AT_ONCE):
        parts = []
        for day in days[low : low + AT_ONCE]:
            values = zip((*PARTITION_KEYS, BATCH_KEY), (tenant.region, tenant.account_id, day, batch), strict=True)
            parts.append("PARTITION (" + ", ".join(f"{ident(k)} = {literal(v)}" for k, v in values) + ")")
        spark.sql(f"ALTER TABLE {table_name(database, table)} ADD IF NOT EXISTS {' '.join(parts)}")
