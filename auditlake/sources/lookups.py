"""Lookup documents as frames: terms, enum ids and mapping rules, one row each."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.plans.mapping import DEFAULT_OUTPUT_TYPE, DEFAULT_PREFIX, EventMapping
from auditlake.sources.local import local_frame

RULE_COLUMNS = (
    "type string, class_name string, rule_no int, source string, condition string, "
    "source_field string, term string, target string, transform string, "
    "output_type string, concat_string string"
)


def as_text(document: str | Mapping[str, Any]) -> str:
    return document if isinstance(document, str) else json.dumps(document)


def _document(spark: SparkSession, text: str, schema: str) -> DataFrame:
    frame = local_frame(spark, [(text,)], "text string")
    parsed = frame.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("document"))
    return parsed.select(F.explode("document").alias("key", "entries"))


def terms_frame(spark: SparkSession, document: str | Mapping[str, Any]) -> DataFrame:
    """``(type, term, caption)``; a type without terms gives no rows."""
    rows = _document(spark, as_text(document), "map<string,map<string,string>>")
    return rows.select(F.col("key").alias("type"), F.explode("entries").alias("term", "caption"))


def enums_frame(spark: SparkSession, document: str | Mapping[str, Any]) -> DataFrame:
    """``(object, attribute, caption, id)`` from tuple-text keys."""
    rows = _document(spark, as_text(document), "map<string,map<string,int>>")
    key_text = r"^\('(.*)', '(.*)'\)$"
    return rows.select(
        F.regexp_extract("key", key_text, 1).alias("object"),
        F.regexp_extract("key", key_text, 2).alias("attribute"),
        F.explode("entries").alias("caption", "id"),
    )


def rules_frame(spark: SparkSession, mapping: EventMapping) -> DataFrame:
    """One row per rule, branch and target, with the attributes as written."""
    rows = []
    for rules in mapping.types.values():
        for number, rule in enumerate(rules.rules):
            branches = [(None, None)]
            if rule.branches is not None:
                branches = [
                    (
                        f"{b.condition.value} {'not in' if b.condition.negated else 'in'} "
                        + ".".join(b.condition.path),
                        ".".join(b.source),
                    )
                    for b in rule.branches
                ]
            rows += [
                (
                    rules.event_type,
                    rules.class_name,
                    number,
                    rule.source_text,
                    condition,
                    source_field,
                    target.term,
                    target.path_text,
                    rule.transform,
                    rule.output_type,
                    rule.prefix,
                )
                for condition, source_field in branches
                for target in rule.targets
            ]
    return local_frame(spark, rows, RULE_COLUMNS)


def with_defaults(rules: DataFrame) -> DataFrame:
    """Fill in the attributes a rule may leave out."""
    return rules.withColumns(
        {
            "output_type": F.coalesce("output_type", F.lit(DEFAULT_OUTPUT_TYPE)),
            "concat_string": F.coalesce("concat_string", F.lit(DEFAULT_PREFIX)),
        }
    )


def types_frame(spark: SparkSession, mapping: EventMapping) -> DataFrame:
    """``(type, class_name)`` of every mapped type."""
    rows = [(t, rules.class_name) for t, rules in mapping.types.items()]
    return local_frame(spark, rows, "type string, class_name string")


def store_bucketed(frame: DataFrame, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A catalog table whose rows lie in buckets by ``keys``, sorted within them.

    Events and a lookup that are stored in the same number of buckets by the keys of the
    join meet bucket by bucket: neither is shuffled, however large the lookup is. A key with
    a third of all rows is a third of all rows of one bucket, so this is for lookups too
    large to broadcast, whose keys are many.
    """
    frame.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(table)
    return frame.sparkSession.table(table)
