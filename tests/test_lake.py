"""Lake writes, routes, side table and replays."""

from __future__ import annotations

import json
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from auditlake import fixtures as fx
from auditlake.operators import filters
from auditlake.plans.compiler import compile_mapping
from auditlake.sources import lake, raw as raw_source
from auditlake.streaming import loading
from auditlake.streaming.loading import load_batch, load_in_one_scan, rejected_events

# these look into the folder of a class
LoadJob = partial(loading.LoadJob, one_scan=False)


@pytest.fixture
def raw(spark, small_dir):
    return fx.audit_view(spark.read.parquet(f"{small_dir}/events.parquet"))


def records_of(raw, class_name):
    compiled = compile_mapping(fx.demo_mapping(), raw, class_name, time_paths=fx.TIME_PATHS)
    return lake.with_partition_keys(compiled.transform(raw), fx.TENANT)


def test_partition_layout_and_leading_zero(spark, raw, tmp_path):
    records = records_of(raw, "authentication")
    counts = lake.write_lake(records, str(tmp_path)).get
    assert counts["transformed"] == counts["authentication"] == records.count()
    leaf = next(tmp_path.glob("region=eu-west-1/accountId=012345678901/eventDay=*/batch=*/*.parquet"))
    assert leaf.exists()
    back = lake.read_lake(spark, str(tmp_path), records.schema)
    assert back.select("accountId").distinct().collect() == [("012345678901",)]
    pruned = back.filter("eventDay = '20240105'")
    assert "PartitionFilters: [isnotnull(eventDay" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == records.filter("eventDay = '20240105'").count()


def test_append_adds_and_batch_replay_replaces(spark, raw, tmp_path):
    records = records_of(raw, "scheduled_job_activity")
    total = records.count()
    for folder, batches, expected in (("append", (None, None), 2), ("replay", ("a-3", "a-3"), 1), ("two", ("a-3", "b-3"), 2), ("mixed", (None, "a-0"), 2)):
        path = str(tmp_path / folder)
        for batch in batches:
            lake.write_lake(records, path, batch=batch)
        assert lake.read_lake(spark, path, records.schema).count() == expected * total


def test_small_batch_leaves_the_rest_of_its_day(spark, raw, tmp_path):
    records = records_of(raw, "authentication")
    lake.write_lake(records, str(tmp_path), batch="a-0")
    lake.write_lake(records.filter("eventDay = '20240105'").limit(5), str(tmp_path), batch="a-1")
    assert lake.read_lake(spark, str(tmp_path), records.schema).count() == records.count() + 5


def test_hot_day_is_written_by_many_tasks(spark, tmp_path):
    """A day with nearly all rows is split by size, and no row is lost."""
    rows = spark.range(300_000, numPartitions=16).select(
        F.lit("authentication").alias("class_name"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        F.lit("r").alias("region"),
        F.lit("0").alias("accountId"),
        F.when(F.col("id") % 50 == 0, "20240102").otherwise("20240101").alias("eventDay"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        lake.write_lake(rows, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list(Path(tmp_path).glob("region=r/accountId=0/eventDay=20240101/batch=*/*.parquet"))
    cold = list(Path(tmp_path).glob("region=r/accountId=0/eventDay=20240102/batch=*/*.parquet"))
    assert len(hot) > 4
    assert len(cold) < len(hot)
    assert lake.read_lake(spark, str(tmp_path), rows.schema).count() == 300_000


def test_one_scan_layout_equals_routes(spark, raw, tmp_path):
    compiled = compile_mapping(fx.demo_mapping(), raw, time_paths=fx.TIME_PATHS)
    records = lake.with_partition_keys(compiled.transform(raw), fx.TENANT)
    counts = lake.write_lake_once(records, str(tmp_path)).get
    assert {p.name for p in tmp_path.glob("class_name=*")} == {f"class_name={c}" for c in lake.CLASS_FOLDERS}
    by_class = {r.class_name: r.n for r in records.groupBy("class_name").agg(F.count("*").alias("n")).collect()}
    assert {c: counts[c] for c in by_class} == by_class


def test_routes(spark):
    assert lake.routes("x") == {
        "account_change": "ext/x-acct-chng",
        "authentication": "ext/x-auth",
        "scheduled_job_activity": "ext/x-sched-job",
    }
    frame = spark.createDataFrame([("authentication",), ("authentication_x",)], "c string")
    assert [r[0] for r in frame.select(lake.route_of(F.col("c"))).collect()] == ["ext/identity-auth", None]
    path = spark.createDataFrame([("/lake/ext/identity-auth/region=r/f.parquet",)], "p string")
    assert path.select(lake.file_route(F.col("p"), "/lake")).first()[0] == "ext_identity-auth"


def write_events(spark, path, *events):
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string").write.mode("append").text(str(path))


def test_bad_events_go_to_the_side_table(spark, tmp_path):
    good = {"id": "1", "type": "AUTH", "created": "2024-01-05T10:00:00Z"}
    write_events(
        spark,
        tmp_path / "in",
        good,
        {**good, "id": "2", "created": "yesterday"},
        {"id": "3", "created": "2024-01-05T10:00:00Z"},
        {**good, "id": "4", "type": "UNMAPPED"},
        {**good, "id": "5", "created": None},
        {**good, "id": "6", "type": "SYSTEM_CONFIG", "created": "?"},
    )
    raw = raw_source.scan_events(spark, str(tmp_path / "in"), "json")
    for load in (load_batch, load_in_one_scan):
        job = LoadJob(fx.demo_mapping(), str(tmp_path / load.__name__), fx.TENANT)
        check_side_table(spark, raw, job, load)


def check_side_table(spark, raw, job, load):
    for _ in range(2):
        result = load(raw, job, 0)
        assert (result.per_class["authentication"], result.transformed, result.rejected) == (1, 1, 4)
    side = spark.read.parquet(job.rejected_location()).collect()
    assert {json.loads(r.event)["id"] for r in side} == {"2", "3", "5", "6"}
    assert len(side) == 4


def test_open_bodies_load(spark, tmp_path):
    write_events(
        spark,
        tmp_path / "in",
        {"type": "AUTH", "created": "2024-01-05T10:00:00Z", "operation": "LOGOUT", "extra": {"deep": [1]}},
        {"type": "AUTH", "created": "2024-01-05T10:00:00Z", "operation": ["LOGOUT"]},
        {"type": "AUTH", "created": "soon"},
    )
    raw = raw_source.scan_open_events(spark, str(tmp_path / "in"))
    job = LoadJob(
        fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT, on_bad="side", variant_column="body"
    )
    result = load_batch(raw, job, 0)
    assert (result.transformed, result.rejected) == (1, 2)
    reasons = {r.reason for r in rejected_events(raw, job).collect()}
    assert reasons == {"a list or object cannot be normalized", "event has no usable day"}
    landed = spark.read.parquet(job.location("authentication"))
    assert landed.select(F.expr("variant_get(data, '$.extra.deep[0]', 'int')"), "activity_id").first() == (1, 2)


def test_nothing_in_nothing_out(spark, raw, tmp_path):
    job = LoadJob(fx.demo_mapping(), str(tmp_path), fx.TENANT)
    result = load_batch(raw.filter("false"), job, 0)
    assert (result.transformed, result.rejected) == (0, 0)
    assert filters.is_empty(raw.filter("false"))
    assert not list(tmp_path.rglob("*.parquet"))


def test_inferred_schema_merges_conflicts(spark):
    staged = spark.createDataFrame(
        [("c", '{"a": 1, "b": "x"}'), ("c", '{"a": "y"}'), ("d", '{"a": 1.5}')], "class_name string, json string"
    )
    found = {r.class_name: r.schema for r in raw_source.infer_schema(staged).collect()}
    assert found == {"c": "OBJECT<a: VARIANT, b: STRING>", "d": "OBJECT<a: DECIMAL(2,1)>"}


def test_json_inference_widens_conflicts(spark, tmp_path):
    """Discovery over staged JSON lines, one folder per class."""
    write_events(spark, tmp_path / "class_name=authentication", {"a": 1, "b": {"c": "x"}})
    write_events(spark, tmp_path / "class_name=account_change", {"a": "y", "d": [1.5]})
    found = raw_source.scan_events(spark, str(tmp_path), "json", schema=None).schema
    assert {f.name: f.dataType.simpleString() for f in found} == {
        "a": "string",
        "b": "struct<c:string>",
        "d": "array<double>",
        "class_name": "string",
    }
