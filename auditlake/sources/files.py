"""What the file system says without a scan."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def listed(spark: SparkSession, pattern: str, sizes: bool = True) -> list[tuple[str, int]]:
    """Paths that a pattern names, with the bytes below them."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(pattern)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in system.globStatus(where) or []]
    return [(p.toString(), system.getContentSummary(p).getLength() if sizes else 0) for p in found]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path with all below it; one that is not there is none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
