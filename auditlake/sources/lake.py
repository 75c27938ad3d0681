"""JSON-lines staging and the partitioned Parquet lake."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.temporal import event_day
from auditlake.operators.metrics import class_counts
from auditlake.sources.files import exists

PARTITION_KEYS = ("region", "accountId", "eventDay")
BATCH_KEY = "batch"

# The three event classes and the suffix of their lake folder.
CLASS_FOLDERS = {
    "account_change": "acct-chng",
    "authentication": "auth",
    "scheduled_job_activity": "sched-job",
}


@dataclass(frozen=True)
class Tenant:
    region: str
    account_id: str


def routes(source: str = "identity") -> dict[str, str]:
    """Lake folder of each event class, ``ext/<source>-<suffix>``."""
    return {name: f"ext/{source}-{suffix}" for name, suffix in CLASS_FOLDERS.items()}


def route_of(class_name: Column, table: Mapping[str, str] | None = None) -> Column:
    """Location of a class; NULL for a class without a route."""
    table = table or routes()
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), class_name)


def file_route(path: Column, root: str) -> Column:
    """Lake folder of a file, from its path below ``root``, as one flat name."""
    below = F.replace(path, F.lit(root.rstrip("/") + "/"), F.lit(""))
    return F.replace(F.regexp_extract(below, r"(ext/[^/]+)/", 1), F.lit("/"), F.lit("_"))


def tenant_columns(df: DataFrame, tenant: Tenant) -> DataFrame:
    return df.withColumns({"region": F.lit(tenant.region), "accountId": F.lit(tenant.account_id)})


def with_partition_keys(records: DataFrame, tenant: Tenant, created: str = "data.created") -> DataFrame:
    """Add region, account and event day to mapped records; ``created`` is SQL text."""
    return tenant_columns(records, tenant).withColumn("eventDay", event_day(created))


def write_jsonl(records: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines, one directory per class."""
    records.write.mode(mode).partitionBy("class_name").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def clustered(records: DataFrame, *keys: str) -> DataFrame:
    """Gather each day's rows into few files.

    AQE merges small shuffle partitions and splits a hot day by size, so a day that
    holds a third of all rows is written by many tasks.
    """
    return records.hint("rebalance", *keys)


def write_lake(
    records: DataFrame,
    path: str,
    *,
    keys: tuple[str, ...] = PARTITION_KEYS,
    cluster_on: tuple[str, ...] = ("eventDay",),
    batch: str | None = None,
) -> Observation:
    """Append keyed records to a lake folder; gives the row counts of this write.

    An empty ``cluster_on`` skips the shuffle, for input already ordered by time.
    Rows go to a ``batch=<name>`` leaf below each day, of a name of its own when none is
    given. A repeat under the same name replaces its own leaves only, so a replay changes
    nothing; a name must therefore never be used for other rows.

    The counts are observed in the stage that writes, above any shuffle, where a
    retried task is counted once.
    """
    observation = Observation()
    if cluster_on:
        records = clustered(records, *cluster_on)
    records = records.observe(observation, *class_counts())
    (
        records.withColumn(BATCH_KEY, F.lit(batch or f"append-{uuid.uuid4().hex}"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys, BATCH_KEY)
        .parquet(path)
    )
    return observation


def write_lake_once(records: DataFrame, path: str, *, batch: str | None = None) -> Observation:
    """All classes in one scan, under ``class_name=<class>`` folders of one record shape.

    The per-class folders need one scan of the raw events each; this layout is for
    large backfills, where one scan matters more than the folder names.
    """
    return write_lake(
        records,
        path,
        keys=("class_name", *PARTITION_KEYS),
        cluster_on=("class_name", "eventDay"),
        batch=batch,
    )


def lake_schema(record: T.StructType, keys: tuple[str, ...] = PARTITION_KEYS) -> T.StructType:
    """Read schema with text partition keys; inference would read an account id as a
    number and drop its leading zeros."""
    fields = [f for f in record.fields if f.name not in keys]
    return T.StructType([*fields, *[T.StructField(k, T.StringType()) for k in keys]])


def read_lake(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    keys: tuple[str, ...] = PARTITION_KEYS,
    *,
    with_path: bool = False,
) -> DataFrame:
    """Records of a lake folder; filters on the keys prune partitions. A folder that
    nothing was written to yet has no records."""
    schema = lake_schema(record, keys)
    if not exists(spark, path):
        return spark.createDataFrame([], schema.add("path", T.StringType()) if with_path else schema)
    found = spark.read.schema(schema).parquet(path)
    file = [F.col("_metadata.file_path").alias("path")] if with_path else []
    return found.select(*[F.col(f"`{n}`") for n in schema.fieldNames()], *file)


def register_table(spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet") -> None:
    """Name existing files as a catalog table; no data moves."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        spark.catalog.createTable(f"{database}.{table}", path=path, source=fmt)

