"""From raw documents to a training mix: five stages, each written and read again.

Every stage takes the documents the one before it kept. All but the last return the
columns of ``documents``; the last adds what the mix takes of each document. Rows without
an id pass the stages that compare documents. Repeated rows are one document with one
verdict, and the mix counts what it takes of them together.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditlake.llm import decontaminate, lines, minhash, mixing, quality  # noqa: E402
from auditlake.llm.native import read_table, table, without  # noqa: E402

SHINGLE, PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier one has; documents left with none go."""
    shorter = lines.dedup_lines(docs, short_copies=True)
    changed = F.col("n_dropped") > 0
    rest = shorter.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rest.withColumn("n_chars", n_chars).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group."""
    found = minhash.near_duplicates(docs, SHINGLE, PERCENT)
    gone = table(found.filter("NOT kept").select(F.col("doc_id").alias("_gone_id")).distinct(), "copies")
    return without(docs, gone, F.col("doc_id") == F.col("_gone_id"), F.xxhash64("doc_id"), F.xxhash64("_gone_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    gone = found.filter("n_hit > 0").select(F.col("doc_id").alias("_gone_id"), F.col("body").alias("_gone_body")).distinct()
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (body == F.col("_gone_body"))
    return without(docs, table(gone, "gone"), same, F.xxhash64("doc_id", body), F.xxhash64("_gone_id", "_gone_body"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: documents with ``size``, ``target`` of their source, ``taken``."""
    rest = [c for c in docs.columns if c not in ("size", "target", "taken")]
    taken = mixing.mix(docs.select("doc_id", "source", "text")).groupBy(
        F.col("doc_id").alias("_id"), F.col("draw").alias("_its_draw")
    ).agg(F.first("size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken"))
    drawn = docs.select(*rest, mixing.draw_of(F.col("doc_id"), F.col("text")).alias("_draw"))
    drawn = drawn.dropDuplicates(["doc_id", "_draw"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_draw") == F.col("_its_draw"))
    return drawn.join(taken.filter("taken > 0"), same).select(*rest, "size", "target", "taken")


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Shared hash buckets and seeded draws are not expressible in SQL; tests compare with
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
