"""Raw audit events from files, catalog tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamReader

# A micro-batch of a large backlog stays within what executors can hold on disk.
MAX_BATCH_BYTES = 10**12

# Only ``type`` and ``created`` are required of a raw event.
RAW_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("actor", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField(
            "attributes",
            T.StructType(
                [
                    T.StructField("sourceName", T.StringType()),
                    T.StructField("tags", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)


def require_utc(spark: SparkSession) -> None:
    """Refuse a session whose zone would shift days and epoch seconds."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, is {zone}")


def scan_events(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = RAW_EVENT
) -> DataFrame:
    """Batch scan with a declared schema, or with ``None`` an inferred one.

    Parquet skips data; JSON does not, and inferring its schema reads it all once.
    """
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def scan_open_events(spark: SparkSession, path: str, column: str = "body") -> DataFrame:
    """JSON lines of open shape as one VARIANT column."""
    return spark.read.option("singleVariantColumn", column).json(path)


def land_open_events(events: DataFrame, path: str, column: str = "body", mode: str = "append") -> None:
    """Store bodies of open shape as Parquet.

    Spark takes the fields that most bodies of a file share out of the VARIANT, each to a
    column of its own. A later read of some fields reads these columns, and a test of a
    field skips row groups, where JSON lines are read and parsed whole.
    """
    events.select(column).write.mode(mode).parquet(path)


def scan_landed_open(spark: SparkSession, path: str, column: str = "body") -> DataFrame:
    """Bodies stored by :func:`land_open_events`."""
    return spark.read.schema(f"`{column}` variant").parquet(path)


def stream_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = RAW_EVENT,
    *,
    max_files: int | None = None,
    max_bytes: int | None = MAX_BATCH_BYTES,
) -> DataFrame:
    """Streaming twin of :func:`scan_events`; the bounds apply to each micro-batch."""
    return _bounded_stream(spark, max_files, max_bytes).format(fmt).schema(schema).load(path)


def stream_open_events(
    spark: SparkSession,
    path: str,
    column: str = "body",
    *,
    max_files: int | None = None,
    max_bytes: int | None = MAX_BATCH_BYTES,
) -> DataFrame:
    """Streaming twin of :func:`scan_open_events`."""
    reader = _bounded_stream(spark, max_files, max_bytes).schema(f"`{column}` variant")
    return reader.option("singleVariantColumn", column).json(path)


def _bounded_stream(spark: SparkSession, max_files: int | None, max_bytes: int | None) -> DataStreamReader:
    # the file source takes one of the two bounds
    if max_files:
        return spark.readStream.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        return spark.readStream.option("maxBytesPerTrigger", max_bytes)
    return spark.readStream


def scan_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def infer_schema(json_text: DataFrame, text: str = "json", by: str = "class_name") -> DataFrame:
    """Discovered schema of JSON text per group, conflicts merged.

    The aggregate keeps one merged schema per group and combines on the map side,
    so a hot group costs no more than any other.
    """
    return json_text.groupBy(by).agg(
        F.expr(f"schema_of_variant_agg(parse_json(`{text}`))").alias("schema")
    )
