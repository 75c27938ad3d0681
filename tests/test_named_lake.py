"""Catalog tables that loads keep, hooks from SQL functions, run history, replays."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from auditlake import fixtures as fx, queries
from auditlake.plans.conditions import condition_column
from auditlake.plans.hooks import sql_function, sql_functions
from auditlake.plans.mapping import MappingError, load_mapping
from auditlake.sources import raw as raw_source
from auditlake.sources.catalog import leaves_of
from auditlake.sources.local import local_frame
from auditlake.sources.terms import ENUMS, TERMS
from auditlake.streaming.history import RunHistory
from auditlake.streaming.ingest import ingest_stream, without_replays
from auditlake.streaming.ledger import FileLedger, RawFiles, ingest_files
from auditlake.streaming.loading import LoadJob, load_batch
from conftest import SMALL_DIR


@pytest.fixture
def raw(spark):
    return fx.audit_view(spark.read.parquet(f"{SMALL_DIR}/events.parquet"))


@pytest.fixture
def database(spark, tmp_path):
    name = f"named_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.mark.parametrize("one_scan", [True, False])
def test_tables_know_new_leaves_and_read_the_days_asked_for(spark, raw, tmp_path, database, one_scan):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT, database=database, one_scan=one_scan)
    early = raw.filter("created < '2024-01-04'")
    load_batch(early, job, 0)
    table = spark.table(f"{database}.authentication")
    assert table.count() == early.filter("type = 'AUTH'").count() > 0
    load_batch(raw.filter("created >= '2024-01-04' AND created < '2024-01-06'"), job, 1)
    load_batch(raw.filter("created >= '2024-01-04' AND created < '2024-01-06'"), job, 1)
    table = spark.table(f"{database}.authentication")
    wanted = raw.filter("type = 'AUTH' AND created < '2024-01-06'")
    assert table.count() == wanted.count() and table.select("accountId").distinct().collect() == [("012345678901",)]
    day = table.filter("eventDay = '20240105'")
    files = day.select("data.id", F.col("_metadata.file_path").alias("f"))
    assert sorted(r.id for r in files.collect()) == sorted(r.id for r in wanted.filter("created >= '2024-01-05'").select("id").collect())
    # the plan holds the leaves of that day only
    assert {f.split("eventDay=")[1][:8] for f in day.inputFiles()} == {"20240105"}
    assert "PartitionFilters: [isnotnull(eventDay" in day._jdf.queryExecution().executedPlan().toString()


def test_leaves_are_found_by_batch(spark, tmp_path):
    for day, batch in (("20240101", "a-1"), ("20240102", "a-1"), ("20240103", "a-12"), ("20240104", "[x]{y}-1")):
        (tmp_path / "region=eu-west-1" / "accountId=012345678901" / f"eventDay={day}" / f"batch={batch}").mkdir(parents=True)
    assert leaves_of(spark, str(tmp_path), fx.TENANT, "a-1") == ["20240101", "20240102"]
    assert leaves_of(spark, str(tmp_path), fx.TENANT, "[x]{y}-1") == ["20240104"]
    assert leaves_of(spark, str(tmp_path / "none"), fx.TENANT, "a-1") == []


def hooked(transform="upper_name"):
    rules = {"operation": [{"target_field": "label", "transform": transform}]}
    return load_mapping({"AUTH": {"staticValues": {"class_name": "authentication"}, "fieldMappings": rules}}, TERMS, ENUMS)


def test_hooks_are_inlined_and_unknown_ones_refused(spark, raw):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION named_upper(word STRING) RETURNS STRING RETURN concat(upper(word), '!')")
    hooks = sql_functions(spark, {"upper_name": "named_upper"})
    job = LoadJob(hooked(), "unused", fx.TENANT, hooks=hooks)
    found = job.compiled(raw).transform(raw)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "named_upper" not in plan and "upper(" in plan and "Python" not in plan
    rows = found.select("data.operation", "label").distinct().collect()
    assert rows and all(r.label == r.operation.upper() + "!" for r in rows)
    with pytest.raises(MappingError, match="there is no SQL function"):
        sql_function(spark, "no_such_function")
    with pytest.raises(MappingError, match="no hook"):
        sql_functions(spark, {"upper_name": "named_upper"}, hooked("other"))
    assert sql_functions(spark, {"upper_name": "named_upper"}, hooked()).keys() == {"upper_name"}


def test_history_adds_up_and_repeats_replace(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    history, ledger = RunHistory(spark, str(tmp_path / "history")), FileLedger(spark, str(tmp_path / "ledger"))
    assert history.coverage().isEmpty() and history.runs().isEmpty()
    runs = [ingest_files(RawFiles(str(tmp_path / "raw")), job, ledger, now, history=history) for now in ("2024-01-10T00:00:00Z", fx.NOW)]
    rows = history.runs().orderBy("batch_id").collect()
    assert [(r.transformed, r.rejected, r.undecided) for r in rows] == [(r.transformed, r.rejected, r.undecided) for r in runs]
    assert [r.authentication for r in rows] == [r.per_class["authentication"] for r in runs]
    first = history.coverage([rows[0].batch]).filter("source = 'status'").agg(F.sum("n_events")).first()[0]
    assert first == runs[0].transformed
    before = sorted(map(str, history.coverage().collect()))
    history.note(raw.filter("created < '2024-01-09T23:00:00.000Z'"), job, runs[0], rows[0].batch.rsplit("-", 1)[0])
    assert sorted(map(str, history.coverage().collect())) == before


def test_state_of_replays_is_bounded_by_the_lag(spark, tmp_path):
    """With no allowance at all the ids of a batch are gone after the next one."""
    for part in range(4):
        rows = [{"id": str(part * 100 + n), "type": "AUTH", "created": "2020-01-05T10:00:00Z"} for n in range(50)]
        rows += [{"id": None, "type": "AUTH", "created": "1999-01-05T10:00:00Z"}] * 2
        lines = spark.createDataFrame([(json.dumps(r),) for r in rows + rows[:5]], "value string").coalesce(1)
        lines.write.mode("append").text(str(tmp_path / "raw"))
    sizes = {}
    for lag in (0, 60):
        events = raw_source.stream_events(spark, str(tmp_path / "raw"), "json", max_files=1)
        job = LoadJob(fx.demo_mapping(), str(tmp_path / f"lake{lag}"), fx.TENANT)
        query = ingest_stream(without_replays(events, lag_minutes=lag), job, str(tmp_path / f"offsets{lag}"))
        query.awaitTermination()
        sizes[lag] = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        ids = [r.id for r in spark.read.parquet(job.shared_location()).select("data.id").collect()]
        # no event is late, however old it says it is
        assert ids.count(None) == 8 and len(set(ids)) == 201 and len(ids) == 208
    assert max(sizes[60]) == 200 and max(sizes[0]) <= 100


def test_conditions_read_their_fields_alone(spark, raw, tmp_path):
    text = raw.select(F.to_json(F.struct("*")).alias("text"))
    raw_source.land_open_events(text.select(F.parse_json("text").alias("body")), str(tmp_path / "open"))
    bodies = raw_source.scan_landed_open(spark, str(tmp_path / "open"))
    tests = [condition_column(c, bodies, "body") for c in ("user_1 in actor.name", "E in operation")]
    plan = bodies.filter(tests[0] & tests[1]).select(F.lit(1))._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert schema.startswith("struct<body:struct<0:variant") and "2:" not in schema, schema


def test_events_are_not_shuffled_for_a_stored_lookup(spark):
    found = queries.bucketed_lookup(spark, SMALL_DIR)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_long_lookups_are_no_sql_text(spark):
    rows = [(f"t{i}", f"term '{i}", None if i % 2 else f"c{i}", i) for i in range(5_000)]
    found = local_frame(spark, rows, "type string, term string, caption string, id int")
    assert sorted(map(tuple, found.collect()), key=lambda r: r[3]) == rows
