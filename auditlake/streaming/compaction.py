"""Merge the small leaves of closed days, so that a day is a few files and not one a batch.

Loads write a ``batch=`` leaf below each day they touch. Once a day is closed its leaves are
read as one and written as one ``batch=compact-...`` leaf. What was merged is logged by class,
day and batch before the old leaves go, and a load leaves out what the log says of its own
batch; so a batch that is repeated later, after a crash or from an old checkpoint, adds
nothing twice. A compaction that was cut off is finished by the next one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.sources.files import exists, listed, remove
from auditlake.sources.lake import BATCH_KEY, PARTITION_KEYS, Tenant

# A leaf is small below this many bytes.
SMALL_BYTES = 128 << 20
LOG = "class_name string, region string, accountId string, eventDay string, batch string, merged string"


def log_of(spark: SparkSession, root: str) -> DataFrame:
    """Which batches were merged, by class and day, and into which."""
    path = f"{root.rstrip('/')}/_compacted"
    if not exists(spark, path):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(path)


def already_merged(spark: SparkSession, root: str, tenant: Tenant, batch: str) -> DataFrame | None:
    """``class_name, eventDay`` of what a batch wrote that lies in merged leaves; None if nothing."""
    if not exists(spark, f"{root.rstrip('/')}/_compacted"):
        return None
    own = (F.col("region") == tenant.region) & (F.col("accountId") == tenant.account_id) & (F.col("batch") == batch)
    found = log_of(spark, root).filter(own).select("class_name", "eventDay")
    return None if found.isEmpty() else found.distinct()


@dataclass(frozen=True)
class Compacted:
    days: int
    leaves: int


def compact(spark: SparkSession, root: str, folders: dict[str, str], tenant: Tenant, before: str, small_bytes: int = SMALL_BYTES) -> Compacted:
    """Merge the small leaves of each day before ``before`` (``yyyyMMdd``), where there are two
    or more; ``folders`` has the lake folder of each class.

    Days and leaves are listed for the tenant alone. The rows of a class are read and
    written by one job for all its days, which rebalances them by day and size.
    """
    finish(spark, root, folders)
    days = leaves = 0
    for class_name, folder in folders.items():
        base = f"{folder.rstrip('/')}/region={tenant.region}/accountId={tenant.account_id}"
        found: dict[str, list[tuple[str, int]]] = {}
        for path, size in listed(spark, f"{base}/eventDay=*/{BATCH_KEY}=*"):
            *_, day, batch = path.split("/")
            if day.removeprefix("eventDay=") < before and size < small_bytes:
                found.setdefault(day.removeprefix("eventDay="), []).append((path, size))
        found = {day: own for day, own in found.items() if len(own) > 1}
        if not found:
            continue
        paths = [path for own in found.values() for path, _ in own]
        merged = f"compact-{uuid.uuid4().hex}"
        _merge(spark, folder, paths, merged)
        _log(spark, root, class_name, tenant, found, merged)
        days, leaves = days + len(found), leaves + len(paths)
    finish(spark, root, folders)
    return Compacted(days, leaves)


def _merge(spark: SparkSession, folder: str, paths: list[str], merged: str) -> None:
    """Write leaves as one below a hidden folder, which readers pass over."""
    keys = [T.StructField(k, T.StringType()) for k in (*PARTITION_KEYS, BATCH_KEY)]
    stored = spark.read.parquet(paths[0]).schema
    schema = T.StructType([*[f for f in stored.fields if f.name not in {k.name for k in keys}], *keys])
    rows = spark.read.schema(schema).option("basePath", folder).parquet(*paths)
    (
        rows.withColumn(BATCH_KEY, F.lit(merged))
        .hint("rebalance", "eventDay")
        .write.mode("overwrite")
        .partitionBy(*PARTITION_KEYS, BATCH_KEY)
        .parquet(f"{folder.rstrip('/')}/_{merged}")
    )


def _log(spark: SparkSession, root: str, class_name: str, tenant: Tenant, found: dict, merged: str) -> None:
    rows = [
        (class_name, tenant.region, tenant.account_id, day, path.rsplit(f"{BATCH_KEY}=", 1)[1], merged)
        for day, own in found.items()
        for path, _ in own
    ]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_compacted")


def finish(spark: SparkSession, root: str, folders: dict[str, str]) -> None:
    """Publish what was merged and logged, then remove the leaves it was made of.

    A merged folder that was not logged is of a compaction that was cut off, and goes.
    """
    pending = {}
    for class_name, folder in folders.items():
        for path, _ in listed(spark, f"{folder.rstrip('/')}/_compact-*", sizes=False):
            pending[path] = class_name, folder
    if not pending:
        return
    logged = [r.asDict() for r in log_of(spark, root).filter(F.col("merged").isin([p.rsplit("/_", 1)[1] for p in pending])).collect()]
    jvm = spark.sparkContext._jvm
    for staged, (class_name, folder) in pending.items():
        merged = staged.rsplit("/_", 1)[1]
        own = [r for r in logged if r["merged"] == merged and r["class_name"] == class_name]
        for row in own:
            day = f"region={row['region']}/accountId={row['accountId']}/eventDay={row['eventDay']}"
            made = f"{staged}/{day}/{BATCH_KEY}={merged}"
            if exists(spark, made):
                where = jvm.org.apache.hadoop.fs.Path(made)
                system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                system.rename(where, jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{day}/{BATCH_KEY}={merged}"))
            remove(spark, f"{folder.rstrip('/')}/{day}/{BATCH_KEY}={row['batch']}")
        remove(spark, staged)
