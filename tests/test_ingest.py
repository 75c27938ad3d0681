"""Incremental runs: streams, positions, replays and crashes."""

from __future__ import annotations

import json
from functools import partial

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from auditlake import fixtures as fx
from auditlake import queries
from auditlake.operators import filters, paging
from auditlake.plans.mapping import load_mapping
from auditlake.sources import lake, raw as raw_source
from auditlake.sources.terms import ENUMS, TERMS
from auditlake.streaming import ingest, loading, position
from conftest import SMALL_DIR
from auditlake.streaming.ingest import ingest_stream, without_replays
from auditlake.streaming.position import Position, PositionStore, run_once

# these look into the folder of a class
LoadJob = partial(loading.LoadJob, one_scan=False)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The audit view as raw Parquet in four files."""
    path = str(tmp_path_factory.mktemp("raw") / "events")
    fx.audit_view(spark.read.parquet(f"{SMALL_DIR}/events.parquet")).repartitionByRange(4, "created").write.parquet(path)
    return path


def lake_rows(spark, job, class_name="authentication"):
    record = job.compiled(spark.createDataFrame([], raw_source.RAW_EVENT), class_name)
    schema = record.transform(spark.createDataFrame([], raw_source.RAW_EVENT)).schema
    return lake.read_lake(spark, job.location(class_name), schema)


def ids(frame):
    return sorted(r[0] for r in frame.select("data.id").collect())


def expected_ids(spark, landed, **bounds):
    raw = raw_source.scan_events(spark, landed).filter("type = 'AUTH'")
    if bounds:
        raw = filters.time_range(raw, bounds.get("after"), bounds.get("before"))
    return sorted(r[0] for r in raw.select("id").collect())


def stream(spark, landed, job, tmp_path, **options):
    events = raw_source.stream_events(spark, landed, **options)
    batches = []
    query = ingest_stream(events, job, str(tmp_path / "offsets"), batches.append)
    query.awaitTermination()
    return batches


def test_stream_in_steps_equals_one_batch(spark, landed, tmp_path):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    batches = stream(spark, landed, job, tmp_path, max_files=1)
    assert len(batches) == 4
    assert ids(lake_rows(spark, job)) == expected_ids(spark, landed)
    # nothing new, nothing done
    assert stream(spark, landed, job, tmp_path, max_files=1) == []


def test_stream_crash_before_commit_replays_once(spark, landed, tmp_path, monkeypatch):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    load = ingest.load_batch

    def crash_after_writing(*batch):
        load(*batch)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(ingest, "load_batch", crash_after_writing)
    with pytest.raises(Exception, match="lost the driver"):
        stream(spark, landed, job, tmp_path)
    monkeypatch.setattr(ingest, "load_batch", load)
    assert [b.batch_id for b in stream(spark, landed, job, tmp_path)] == [0]
    assert ids(lake_rows(spark, job)) == expected_ids(spark, landed)


def test_replayed_deliveries_are_dropped(spark, landed, tmp_path):
    doubled = str(tmp_path / "doubled")
    for _ in range(2):
        spark.read.parquet(landed).write.mode("append").parquet(doubled)
    events = raw_source.stream_events(spark, doubled)
    query = (
        without_replays(events)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "offsets"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(landed).count()


@pytest.mark.parametrize("limit", [None, "400"])
def test_runs_in_steps_equal_one_range(spark, landed, tmp_path, limit):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    store = PositionStore(spark, str(tmp_path / "state"))
    source = raw_source.scan_events(spark, landed)
    runs = 0
    for now in ("2024-01-12T00:00:00Z", fx.NOW):
        while run_once(source, job, store, now, limit=limit, bounded=limit is not None):
            runs += 1
    assert runs == 2 if limit is None else runs > 2
    assert ids(lake_rows(spark, job)) == expected_ids(spark, landed, before="2024-01-30T23:00:00Z")
    assert run_once(source, job, store, fx.NOW) is None


def test_run_crash_before_commit_repeats_the_plan(spark, landed, tmp_path, monkeypatch):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    store = PositionStore(spark, str(tmp_path / "state"))
    source = raw_source.scan_events(spark, landed)
    load = position.load_batch

    def crash_after_writing(*batch):
        load(*batch)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(position, "load_batch", crash_after_writing)
    with pytest.raises(RuntimeError):
        run_once(source, job, store, "2024-01-12T00:00:00Z")
    planned = store.read()
    assert not planned.committed and planned.batch_id == 0
    monkeypatch.setattr(position, "load_batch", load)
    # the clock has moved on, the plan has not
    run_once(source, job, store, fx.NOW)
    assert store.read() == Position(0, True, planned.until, run=planned.run)
    assert ids(lake_rows(spark, job)) == expected_ids(spark, landed, before="2024-01-11T23:00:00Z")
    run_once(source, job, store, fx.NOW)
    assert ids(lake_rows(spark, job)) == expected_ids(spark, landed, before="2024-01-30T23:00:00Z")


def test_equal_times_are_never_cut(spark, tmp_path):
    events = [
        {"id": str(n), "type": "AUTH", "created": f"2024-01-05T{n // 10:02d}:00:00.000Z"} for n in range(20)
    ]
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string").write.text(str(tmp_path / "in"))
    source = raw_source.scan_events(spark, str(tmp_path / "in"), "json")
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    store = PositionStore(spark, str(tmp_path / "state"))
    sizes = []
    while done := run_once(source, job, store, fx.NOW, limit=7, bounded=True):
        sizes.append(done.transformed)
    assert sizes == [10, 10]


def test_position_store_keeps_the_latest(spark, tmp_path):
    store = PositionStore(spark, str(tmp_path / "state"))
    assert store.read() is None
    for batch_id in range(4):
        store.write(Position(batch_id, False, f"p{batch_id}", f"u{batch_id}"))
        assert store.read() == Position(batch_id, False, f"p{batch_id}", f"u{batch_id}")
        store.write(Position(batch_id, True, f"u{batch_id}"))
        assert store.read() == Position(batch_id, True, f"u{batch_id}")


def test_clamped_run_skips_a_stale_backlog(spark, landed, tmp_path):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    store = PositionStore(spark, str(tmp_path / "state"))
    source = raw_source.scan_events(spark, landed)
    assert run_once(source, job, store, fx.NOW, clamp=True) is None


def test_open_range_and_offsets(spark):
    frame = spark.createDataFrame(
        [("a", "2024-01-10T00:00:00.000Z"), ("b", "2024-01-10T00:00:00.001Z"), ("c", "2024-01-10T01:30:00+02:00"),
         ("d", "2024-01-10T23:59:59Z"), ("e", "2024-01-11T00:00:00.000Z"), ("f", "2024-01-11T01:59:59+02:00"), ("g", "10"), ("h", None)],
        "id string, created string",
    )
    kept = filters.time_range(frame, "2024-01-10T00:00:00.000Z", "2024-01-11T00:00:00.000Z")
    assert {r.id for r in kept.collect()} == {"b", "d", "f"}


def test_session_zone_is_checked(spark):
    raw_source.require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            raw_source.require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_open_bodies_stream(spark, tmp_path):
    body = {"type": "AUTH", "created": "2024-01-05T10:00:00Z", "operation": "LOGOUT"}
    spark.createDataFrame([(json.dumps(body),)], "value string").write.text(str(tmp_path / "in"))
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT, variant_column="body")
    events = raw_source.stream_open_events(spark, str(tmp_path / "in"))
    batches = []
    ingest_stream(events, job, str(tmp_path / "offsets"), batches.append).awaitTermination()
    assert [(b.transformed, b.rejected) for b in batches] == [(1, 0)]
    assert spark.read.parquet(job.location("authentication")).first().activity_id == 2


def test_failed_load_leaves_the_position(spark, landed, tmp_path, monkeypatch):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    store = PositionStore(spark, str(tmp_path / "state"))
    source = raw_source.scan_events(spark, landed)

    def fail(*_):
        raise OSError("disk full")

    monkeypatch.setattr(position, "load_batch", fail)
    for _ in range(2):
        with pytest.raises(OSError):
            run_once(source, job, store, fx.NOW)
        assert store.read().position == filters.DEFAULT_START
        assert not store.read().committed


def all_ids(spark, job):
    """Ids of all records and of all side rows."""
    found = []
    for class_name in job.mapping.classes():
        found += ids(lake_rows(spark, job, class_name))
    try:
        side = spark.read.parquet(job.rejected_location()).collect()
    except AnalysisException:
        side = []
    return sorted(found, key=int), sorted((json.loads(r.event)["id"] for r in side), key=int)


def put(spark, path, *events):
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string").coalesce(1).write.mode("append").text(str(path))


def auth(n, created="2024-01-05T10:00:00Z", **more):
    return {"id": str(n), "type": "AUTH", "created": created, **more}


def test_run_and_streams_share_a_lake(spark, tmp_path):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    put(spark, tmp_path / "one", *[auth(n) for n in range(10)])
    put(spark, tmp_path / "two", *[auth(n) for n in range(10, 13)])
    put(spark, tmp_path / "three", auth(13), auth(14, "soon"))
    run_once(raw_source.scan_events(spark, str(tmp_path / "one"), "json"), job, PositionStore(spark, str(tmp_path / "p")), fx.NOW)
    for name in ("two", "three"):
        events = raw_source.stream_events(spark, str(tmp_path / name), "json")
        ingest_stream(events, job, str(tmp_path / f"offsets-{name}")).awaitTermination()
    assert all_ids(spark, job) == ([str(n) for n in range(14)], ["14"])


def test_tenants_keep_their_own_side_rows(spark, tmp_path):
    for tenant, bad in ((lake.Tenant("r", "111"), (1, 2)), (lake.Tenant("r", "222"), (3,))):
        job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), tenant)
        put(spark, tmp_path / tenant.account_id, *[auth(n, "soon") for n in bad])
        loading.load_batch(raw_source.scan_events(spark, str(tmp_path / tenant.account_id), "json"), job, 0)
    assert all_ids(spark, job)[1] == ["1", "2", "3"]


@pytest.mark.parametrize("one_scan", [False, True])
def test_events_out_of_any_range_go_aside_once(spark, tmp_path, one_scan):
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT, one_scan=one_scan)
    store = PositionStore(spark, str(tmp_path / "p"))
    put(spark, tmp_path / "in", auth(1), auth(2, "soon"), auth(3, None), {"id": "4", "created": "2024-01-05T10:00:00Z"}, auth(5, "soon", type="UNMAPPED"))
    source = raw_source.scan_events(spark, str(tmp_path / "in"), "json")
    done = run_once(source, job, store, fx.NOW)
    assert (done.transformed, done.rejected) == (1, 3)
    assert run_once(source, job, store, fx.NOW) is None
    put(spark, tmp_path / "in", auth(6, "later"))
    source = raw_source.scan_events(spark, str(tmp_path / "in"), "json")
    done = run_once(source, job, store, fx.NOW)
    assert (done.transformed, done.rejected) == (0, 1)
    assert run_once(source, job, store, fx.NOW) is None
    side = spark.read.parquet(job.rejected_location()).collect()
    assert sorted(json.loads(r.event)["id"] for r in side) == ["2", "3", "4", "6"]


def test_any_bound_is_taken_as_given(spark):
    ticks = spark.range(15_500).selectExpr("CAST(id AS STRING) AS id", "timestamp_seconds(id) AS created")
    assert paging.bounded_batch(ticks, 15_000).rows.count() == 15_000
    assert paging.bounded_batch(ticks, 0).rows.count() == paging.bounded_batch(ticks, None).rows.count() == 15_500


def test_stream_queries_are_right_for_many_batches_and_none(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL_DIR}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "three" / "events.parquet"))
    events.limit(0).write.parquet(str(tmp_path / "none" / "events.parquet"))
    job, raw = queries._ingested(spark, str(tmp_path / "three"), "t", load=queries.load_twice, max_files=1)
    found = queries.landed(spark, job, raw)
    expected = queries.stream_ingest(spark, SMALL_DIR)
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
    assert queries.stream_commit(spark, str(tmp_path / "none")).isEmpty()


def test_one_scan_reads_clean_events_once(spark, landed, tmp_path):
    """Clean events cost one pass; one without a type costs the search for it as well."""
    clean = raw_source.scan_events(spark, landed).filter("type IS NOT NULL")
    jobs = []
    for name, raw in (("clean", clean), ("bad", raw_source.scan_events(spark, landed).withColumn("type", F.expr("nullif(type, 'AUTH')")))):
        spark.sparkContext.setJobGroup(name, name)
        job = LoadJob(fx.demo_mapping(), str(tmp_path / name), fx.TENANT, one_scan=True)
        loading.load_batch(raw, job, 0)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[0] < jobs[1] and not list((tmp_path / "clean").glob("rejected*"))


def test_declared_types_land_from_open_bodies(spark, tmp_path):
    document = json.loads(json.dumps(fx.DEMO_MAPPING))
    document["AUTH"]["fieldMappings"]["size"] = [{"target_field": "metadata.size"}]
    mapping = load_mapping(json.dumps(document), TERMS, ENUMS)
    put(spark, tmp_path / "in", auth(1, size=5_000_000_000))
    job = LoadJob(
        mapping, str(tmp_path / "lake"), fx.TENANT, variant_column="body", target_types={"metadata.size": "bigint"}
    )
    events = raw_source.stream_open_events(spark, str(tmp_path / "in"))
    ingest_stream(events, job, str(tmp_path / "offsets")).awaitTermination()
    assert spark.read.parquet(job.location("authentication")).first().metadata.size == 5_000_000_000


@pytest.mark.parametrize("name", ["compile", "load", "one", "run", "stream", "range"])
def test_other_zones_are_refused(spark, landed, tmp_path, name):
    raw = raw_source.scan_events(spark, landed)
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
    calls = {
        "compile": lambda: job.compiled(raw),
        "load": lambda: loading.load_batch(raw, job, 0),
        "one": lambda: loading.load_in_one_scan(raw, job, 0),
        "run": lambda: run_once(raw, job, PositionStore(spark, str(tmp_path / "p")), fx.NOW),
        "stream": lambda: ingest_stream(raw_source.stream_events(spark, landed), job, str(tmp_path / "o")),
        "range": lambda: filters.time_range(raw, fx.CHECKPOINT, None),
    }
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            calls[name]()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_deliveries_are_written_by_all_tasks(spark, tmp_path):
    """Each delivery used to be one file, so one task wrote it and few read it."""
    folder = tmp_path / "in" / "events.parquet"
    events = spark.range(120, numPartitions=3).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-05 10:00:00' AS ts", "id % 10 AS user_id", "'view' AS event_type", "1.0D AS value", "'{\"k\": 2}' AS props"
    )
    events.write.parquet(str(folder))
    found = queries.replay_dedup(spark, str(tmp_path / "in"))
    # the three events without an id come again and are no replays
    assert found.count() == 123 and found.filter("id IS NOT NULL").distinct().count() == 117
    raw = next(f for f in found.inputFiles()).split("/lake/")[0] + "/raw"
    assert len(spark.read.parquet(raw).inputFiles()) > 4
