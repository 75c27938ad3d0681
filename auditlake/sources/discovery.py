"""Schema discovery by path: what is where, of which kind, and how often.

The rows of two sets of events can be added up, so a day's discovery is kept and merged with
the next, and conflicts stay visible as several kinds of one path with their counts, where a
merged type text would only say that they were mixed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.sources.workspace import fresh_folder

# Keys that are ids: digits, UUIDs, or long hex numbers. They are one key, written ``*``.
ID_KEY = r"^([0-9]+|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9a-fA-F]{16,})$"
ANY_KEY = "*"
LISTED = "[]"


def _kind(value: str):
    return F.regexp_extract(F.expr(f"schema_of_variant({value})"), r"^[^<]+", 0)


def _children(level: DataFrame, by: str, id_key: str) -> DataFrame:
    """What lies directly below objects and lists; a list's items share one path."""
    name = F.when(F.col("key").rlike(id_key), ANY_KEY).when(F.col("key").rlike(r"[.\[\]*]"), F.concat(F.lit("['"), "key", F.lit("']"))).otherwise(F.col("key"))
    path = F.when(F.col("key").isNull(), F.concat("path", F.lit(LISTED))).when(F.col("path") == "", name).otherwise(F.concat("path", F.lit("."), name))
    held = level.selectExpr(f"`{by}`", "path", "inline(array(named_struct('body', body)))")
    each = held.lateralJoin(held.sparkSession.tvf.variant_explode(F.col("body").outer()))
    return each.select(by, F.col("path").alias("parent"), path.alias("path"), F.col("value").alias("body"))


def discover_paths(events: DataFrame, body: str = "body", by: str = "class_name", id_key: str = ID_KEY) -> DataFrame:
    """``by, parent, path, type, n`` of the VARIANT bodies of events.

    Bodies are worked off level by level; only objects and lists go on to the next one,
    through the shared folder, and counts are added up before they are shuffled. The body
    itself has the empty path.
    """
    spark = events.sparkSession
    level = events.select(by, F.lit(None).cast("string").alias("parent"), F.lit("").alias("path"), F.col(f"`{body}`").alias("body"))
    level = level.filter("body IS NOT NULL").withColumn("type", _kind("body"))
    counts = []
    while True:
        counted = level.groupBy(by, "parent", "path", "type").agg(F.count("*").alias("n"))
        folder = fresh_folder(spark, "paths")
        counted.write.parquet(folder)
        counts.append(spark.read.schema(counted.schema).parquet(folder))
        holders = level.filter("type IN ('OBJECT', 'ARRAY')").select(by, "path", "body")
        if counts[-1].filter("type IN ('OBJECT', 'ARRAY')").isEmpty():
            return merge_paths(*counts, by=by)
        found = _children(holders, by, id_key).withColumn("type", _kind("body"))
        folder = fresh_folder(spark, "level")
        # leaves are done with; only what holds more is kept whole
        kept = found.withColumn("body", F.when(F.col("type").isin("OBJECT", "ARRAY"), F.col("body")))
        kept.write.parquet(folder)
        level = spark.read.schema(kept.schema).parquet(folder)


def merge_paths(*found: DataFrame, by: str = "class_name") -> DataFrame:
    """One set of rows for several."""
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy(by, "parent", "path", "type").agg(F.sum("n").alias("n"))


def with_shares(found: DataFrame, by: str = "class_name") -> DataFrame:
    """Add ``n_objects``, the objects that could have the path as a key, and whether it is
    ``optional`` or in ``conflict``; what is no key of an object has neither number nor
    option. JSON nulls conflict with nothing."""
    objects = found.filter("type = 'OBJECT'").select(F.col(by).alias("_by"), F.col("path").alias("_path"), F.col("n").alias("n_objects"))
    kinds = found.groupBy(by, "path").agg(F.sum("n").alias("n_all"), F.count_if(F.col("type") != "VOID").alias("n_kinds"))
    held = found.join(kinds, [by, "path"]).join(objects, (F.col(by) == F.col("_by")) & (F.col("parent") == F.col("_path")), "left")
    is_key = ~F.col("path").endswith(LISTED) & ~F.col("path").endswith(ANY_KEY)
    n_objects = F.when(is_key, F.col("n_objects"))
    return held.select(
        by, "path", "type", "n", n_objects.alias("n_objects"), (F.col("n_all") < n_objects).alias("optional"), (F.col("n_kinds") > 1).alias("conflict")
    )
