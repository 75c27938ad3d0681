"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from auditlake import fixtures as fx
from conftest import SF_DIR
from auditlake.operators import filters, lookups, metrics, paging
from auditlake.plans.compiler import compile_mapping
from auditlake.queries import QUERIES, raw_between
from auditlake.sources import raw as raw_source
from auditlake.sources.lookups import terms_frame
from auditlake.sources.terms import TERMS


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    fx.audit_view(spark.read.parquet(f"{SF_DIR}/events.parquet")).write.parquet(path)
    return raw_source.scan_events(spark, path)


def test_transform_is_one_narrow_stage(stored):
    text = plan(compile_mapping(fx.demo_mapping(), stored, "authentication", time_paths=fx.TIME_PATHS).transform(stored))
    assert shuffles(text) == 0
    assert "Python" not in text
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,AUTH)]" in text


def test_all_classes_push_the_type_list(stored):
    text = plan(compile_mapping(fx.demo_mapping(), stored, time_paths=fx.TIME_PATHS).transform(stored))
    assert shuffles(text) == 0
    assert "In(type, [" in text


def test_unused_raw_fields_are_not_read(stored):
    records = compile_mapping(fx.demo_mapping(), stored, "authentication").transform(stored)
    text = plan(records.select("activity_id", "data.id"))
    # status is the key of the other lookup
    assert "ReadSchema: struct<id:string,type:string,operation:string,status:string>" in text


@pytest.mark.parametrize(
    ("targets", "joins", "read"),
    [
        ((), 1, "struct<type:string>"),
        (("data",), 1, "struct<id:string,type:string,created:string,operation:string,status:string"),
        (("status_id",), 2, "struct<type:string,status:string>"),
        (("activity_id", "activity_name"), 2, "struct<type:string,operation:string>"),
    ],
)
def test_only_the_lookups_of_the_targets_are_joined(stored, targets, joins, read):
    whole = compile_mapping(fx.demo_mapping(), stored, time_paths=fx.TIME_PATHS)
    part = compile_mapping(fx.demo_mapping(), stored, time_paths=fx.TIME_PATHS, targets=targets)
    records = part.transform(stored)
    assert set(records.columns) == {"class_name", *targets}
    text = plan(records)
    assert text.count("BroadcastHashJoin") <= joins and f"ReadSchema: {read}" in text
    same = whole.transform(stored).select(*records.columns)
    if "data" not in targets:
        assert records.exceptAll(same).isEmpty() and same.exceptAll(records).isEmpty()


def test_range_and_types_reach_the_scan(spark, sf_dir, stored):
    wanted = filters.of_types(filters.time_range(stored, fx.CHECKPOINT, fx.NOW), ["AUTH", "ACCESS_ITEM"])
    text = plan(wanted.select("id"))
    assert "In(type, [ACCESS_ITEM,AUTH])" in text or "In(type, [AUTH,ACCESS_ITEM])" in text
    assert "GreaterThanOrEqual(created,2024-01-09)" in text
    assert "LessThan(created,2024-02-02)" in text
    text = plan(raw_between(spark, sf_dir, fx.CHECKPOINT, fx.NOW))
    assert "GreaterThan(ts,2024-01-10T00:00)" in text


def test_pages_are_top_n(stored):
    text = plan(paging.page(stored, 100, 50))
    assert "TakeOrderedAndProject" in text
    assert shuffles(text) == 0


def test_lookups_are_broadcast_and_counts_partial(spark, stored):
    captioned = lookups.normalize_term(stored, terms_frame(spark, TERMS), "operation", 52, hit="hit")
    assert "BroadcastHashJoin" in plan(captioned)
    assert shuffles(plan(captioned)) == 0
    text = plan(metrics.lookup_coverage(captioned, "operation"))
    assert "partial_count" in text


def test_no_query_uses_python_workers(spark, sf_dir):
    for name, query in QUERIES.items():
        if name.startswith(("stream", "lake", "jsonl", "run_metrics")):
            continue
        text = plan(query(spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_hot_key_counts_shuffle_one_row_per_group(spark):
    """A third of all rows on one key: the map side sums them before the shuffle."""
    rows = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "authentication").otherwise("account_change").alias("class_name")
    )
    counted = metrics.per_class(rows)
    assert dict(counted.collect()) == {"authentication": 66_667, "account_change": 133_333}
    assert "partial_count" in plan(counted)


def test_generated_code_stays_small(spark, stored):
    """The JVM compiles no method above 8000 bytes of code."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        records = compile_mapping(fx.demo_mapping(), stored, time_paths=fx.TIME_PATHS).transform(stored)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = records._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) == 1 and sizes[0] < 8000
