"""Merged leaves: same rows, fewer leaves, no doubles after a replay or a crash."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auditlake import fixtures as fx
from auditlake.streaming import compaction
from auditlake.streaming.loading import LoadJob, compact_days, load_batch
from conftest import SMALL_DIR


@pytest.fixture
def case(spark, tmp_path):
    """A lake of three days in three batches each, with a catalog."""
    raw = fx.audit_view(spark.read.parquet(f"{SMALL_DIR}/events.parquet")).filter("created < '2024-01-04'")
    database = f"compact_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{tmp_path}/db'")
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT, database=database)
    parts = [raw.filter(F.pmod(F.col("id").cast("bigint"), F.lit(3)) == k) for k in range(3)]
    for batch_id, part in enumerate(parts):
        load_batch(part, job, batch_id)
    yield job, parts, tmp_path
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def rows_of(spark, job):
    return sorted(r[0] for r in spark.read.parquet(job.shared_location()).select("data.id").collect())


def leaves_of(tmp_path):
    return {p.parent.name.removeprefix("eventDay="): sum(1 for _ in p.parent.iterdir()) for p in tmp_path.glob("lake/**/class_name=account_change/**/batch=*")}


def test_closed_days_become_one_leaf(spark, case):
    job, parts, tmp_path = case
    before = rows_of(spark, job)
    assert leaves_of(tmp_path) == {"20240101": 3, "20240102": 3, "20240103": 3}
    done = compact_days(spark, job, before="20240103")
    assert done.days >= 4 and rows_of(spark, job) == before
    assert leaves_of(tmp_path) == {"20240101": 1, "20240102": 1, "20240103": 3}
    named = sum(spark.table(f"{job.database}.{c}").count() for c in job.mapping.classes() if spark.catalog.tableExists(f"{job.database}.{c}"))
    assert named == len(before)
    # every old batch may come again, and a new one adds to the day
    for batch_id, part in enumerate(parts):
        load_batch(part, job, batch_id)
    assert rows_of(spark, job) == before
    load_batch(parts[0].filter("created < '2024-01-02'"), job, 7)
    assert len(rows_of(spark, job)) > len(before) and leaves_of(tmp_path)["20240101"] == 2
    compact_days(spark, job, before="20240103")
    assert leaves_of(tmp_path)["20240101"] == 1
    load_batch(parts[1], job, 1)
    assert compact_days(spark, job, before="20240103") == compaction.Compacted(0, 0)


@pytest.mark.parametrize("at", ["_log", "remove"])
def test_a_cut_off_compaction_is_finished(spark, case, monkeypatch, at):
    job, parts, _ = case
    before = rows_of(spark, job)
    real = getattr(compaction, at)

    def crash(*args):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(compaction, at, crash)
    with pytest.raises(RuntimeError):
        compact_days(spark, job, before="20240103")
    monkeypatch.setattr(compaction, at, real)
    compact_days(spark, job, before="20240103")
    load_batch(parts[2], job, 2)
    assert rows_of(spark, job) == before
