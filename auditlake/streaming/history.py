"""What each run did, as rows that can be added up for any span of runs.

A batch leaves two small tables beside the position: how many events of each type had which
term and whether the terms table knows it, and one row of counts of the load. A repeat of
the batch replaces its own. Nothing is counted again to answer for a day or a month.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.sqltext import literal, variant_path
from auditlake.plans.mapping import EVENT_CLASSES
from auditlake.sources.files import exists
from auditlake.sources.local import local_frame, small
from auditlake.sources.lookups import terms_frame
from auditlake.streaming.loading import LoadJob, LoadResult

TERM_COLUMNS = "source string, type string, term string, hit boolean, n bigint, batch string"
RUN_COLUMNS = "batch_id bigint, class_name string, transformed bigint, rejected bigint, undecided bigint, batch string"


@dataclass(frozen=True)
class RunHistory:
    """Counts by batch below ``path``; ``sources`` are the fields whose terms are counted."""

    spark: SparkSession
    path: str
    sources: tuple[str, ...] = ("operation", "status")

    def note(self, rows: DataFrame, job: LoadJob, loaded: LoadResult, run: str) -> None:
        """Keep the counts of one loaded batch."""
        batch = f"{run}-{loaded.batch_id}"
        self._write(self._terms(rows, job), "terms", batch)
        counts = [(loaded.batch_id, c, loaded.per_class.get(c, 0), 0, 0) for c in EVENT_CLASSES]
        counts.append((loaded.batch_id, None, 0, loaded.rejected, loaded.undecided))
        schema = T.StructType(T.StructType.fromDDL(RUN_COLUMNS).fields[:-1])
        self._write(local_frame(self.spark, counts, schema), "runs", batch)

    def _terms(self, rows: DataFrame, job: LoadJob) -> DataFrame:
        """Terms of a batch; at most one row a distinct term is shuffled from a task."""

        def field(name: str) -> str:
            if job.variant_column:
                return f"try_variant_get(`{job.variant_column}`, {variant_path(name.split('.'))}, 'string')"
            return f"CAST({name} AS STRING)"

        pairs = ", ".join(f"{literal(s)}, {field(s)}" for s in self.sources)
        kinds = rows.filter(F.expr(field("type")).isin(list(job.mapping.wanted_types)))
        used = kinds.selectExpr(f"{field('type')} AS type", f"stack({len(self.sources)}, {pairs}) AS (source, term)")
        counted = used.groupBy("source", "type", "term").agg(F.count("*").alias("n"))
        known = terms_frame(self.spark, job.mapping.terms).select("type", "term", F.lit(True).alias("hit"))
        n_terms = sum(len(captions) for captions in job.mapping.terms.values())
        joined = counted.join(small(known, n_terms), ["type", "term"], "left")
        return joined.select("source", "type", "term", F.coalesce("hit", F.lit(False)).alias("hit"), "n")

    def _write(self, rows: DataFrame, kind: str, batch: str) -> None:
        (
            rows.coalesce(1)
            .withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(f"{self.path.rstrip('/')}/{kind}")
        )

    def _read(self, kind: str, columns: str, batches: Collection[str] | None) -> DataFrame:
        path = f"{self.path.rstrip('/')}/{kind}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], columns)
        rows = self.spark.read.schema(columns).parquet(path)
        return rows if batches is None else rows.filter(F.col("batch").isin(list(batches)))

    def coverage(self, batches: Collection[str] | None = None) -> DataFrame:
        """Events and distinct terms that hit or miss, by source and type, over a span."""
        rows = self._read("terms", TERM_COLUMNS, batches)
        per_term = rows.groupBy("source", "type", "hit", "term").agg(F.sum("n").alias("n"))
        return per_term.groupBy("source", "type", "hit").agg(F.sum("n").alias("n_events"), F.count("term").alias("n_terms"))

    def runs(self, batches: Collection[str] | None = None) -> DataFrame:
        """Counts of each load, by batch."""
        rows = self._read("runs", RUN_COLUMNS, batches)
        by_class = [F.sum(F.when(F.col("class_name") == c, F.col("transformed"))).alias(c) for c in EVENT_CLASSES]
        sums = [F.sum(c).alias(c) for c in ("transformed", "rejected", "undecided")]
        return rows.groupBy("batch", "batch_id").agg(*sums, *by_class)
