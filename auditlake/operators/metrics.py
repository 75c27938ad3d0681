"""Counts and positions of a run."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.temporal import instant
from auditlake.operators.paging import effective_limit
from auditlake.plans.mapping import EVENT_CLASSES


def per_class(records: DataFrame) -> DataFrame:
    """Number of records of each class."""
    return records.groupBy("class_name").agg(F.count("*").alias("n_events"))


def class_counts(column: str = "class_name") -> list:
    """Aggregates for ``observe``: total and one count per known class."""
    counts = [F.count(F.lit(1)).alias("transformed")]
    return counts + [F.count_if(F.col(column) == c).alias(c) for c in EVENT_CLASSES]


def observed(observation: Observation) -> dict[str, int] | None:
    """Counts seen by a finished action.

    None when the planner found at run time that nothing is left to do and dropped
    the node that counts.
    """
    try:
        return observation.get
    except Py4JJavaError:
        return None


def next_position(df: DataFrame, column: str = "created") -> DataFrame:
    """Text of the latest time among the rows read, as one row; NULL when empty."""
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    at = instant(f"`{column}`") if is_text else F.col(column)
    return df.agg(F.max_by(column, at).alias("next_checkpoint"))


def total_and_caught_up(df: DataFrame, limit: int | str | None) -> DataFrame:
    """Rows matching before the limit, and whether one page holds them all."""
    return df.agg(F.count("*").alias("total")).withColumn(
        "caught_up", F.col("total") < F.lit(effective_limit(limit))
    )


def lookup_coverage(df: DataFrame, term: str, hit: str = "hit") -> DataFrame:
    """Events and distinct terms per type that hit or miss the terms table.

    Counting per term first means only one row per distinct term is shuffled for
    the second step.
    """
    per_term = df.groupBy("type", hit, term).agg(F.count("*").alias("n"))
    return per_term.groupBy("type", hit).agg(
        F.sum("n").alias("n_events"), F.count(term).alias("n_terms")
    )
