"""Read position of the batch ingest, kept as rows in the shared folder.

For sources without files of their own, such as tables; raw files are better read by the
ledger of :mod:`auditlake.streaming.ledger`, which does not look at history again.

A run writes what it is about to read before it loads, and its new position after.
A run that finds a plan without its commit repeats exactly that plan, so a crash
neither loses nor doubles events.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.temporal import SAFETY_LAG_MINUTES, clamp_position, instant, iso_text
from auditlake.operators.filters import DEFAULT_START, of_types, time_range, upper_bound
from auditlake.operators.metrics import next_position
from auditlake.operators.paging import bounded_batch
from auditlake.sources.files import exists
from auditlake.sources.raw import require_utc
from auditlake.streaming.loading import LoadJob, LoadResult, load_batch, write_unreadable

STATE_COLUMNS = "batch_id bigint, committed boolean, position string, until string, run string, slot int"


@dataclass(frozen=True)
class Position:
    """``position`` is where reading starts, ``until`` the inclusive end of a plan, and
    ``run`` the name that the store was given with its first plan."""

    batch_id: int
    committed: bool
    position: str | None
    until: str | None = None
    run: str = ""


class PositionStore:
    """The last two plans and commits, each in a folder of its own.

    A write replaces one folder only, never the one the current state is read from.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> Position | None:
        if not exists(self.spark, self.path):
            return None
        rows = self.spark.read.schema(STATE_COLUMNS).json(self.path)
        latest = rows.orderBy(F.desc("batch_id"), F.desc("committed")).first()
        if latest is None:
            return None
        return Position(latest.batch_id, latest.committed, latest.position, latest.until, latest.run or "")

    def write(self, state: Position) -> None:
        slot = 2 * (state.batch_id % 2) + int(state.committed)
        row = (state.batch_id, state.committed, state.position, state.until, state.run, slot)
        (
            self.spark.createDataFrame([row], STATE_COLUMNS)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot")
            .json(self.path)
        )


def clamp_checkpoint(
    df: DataFrame, saved: str, now: str, lag_minutes: int = SAFETY_LAG_MINUTES, output: str = "position"
) -> DataFrame:
    """Move saved positions that are a day or more behind to ``now - lag``."""
    clock = F.lit(now).cast("timestamp")
    return df.withColumn(output, iso_text(clamp_position(instant(f"`{saved}`"), clock, lag_minutes)))


def run_once(
    source: DataFrame,
    job: LoadJob,
    store: PositionStore,
    now: str,
    *,
    limit: int | str | None = None,
    bounded: bool = False,
    start: str = DEFAULT_START,
    lag_minutes: int = SAFETY_LAG_MINUTES,
    clamp: bool = False,
) -> LoadResult | None:
    """One incremental run over raw events with a ``created`` column.

    Takes everything newer than the position that has settled; with ``bounded`` only
    about ``limit`` of the oldest. Gives None when there is nothing to read. The
    position moves last, past every event read. Events without a type or a usable time
    are in no range; the new ones among them go to the side table and are counted as
    rejected.
    """
    require_utc(store.spark)
    aside = write_unreadable(source, job)
    last = store.read()
    wanted = of_types(source, job.mapping.wanted_types)
    if last is not None and not last.committed:
        plan = last
    else:
        after = last.position if last else start
        if clamp:
            one = store.spark.createDataFrame([(after,)], "saved string")
            after = clamp_checkpoint(one, "saved", now, lag_minutes).first().position
        ready = time_range(wanted, after, upper_bound(now, lag_minutes))
        if bounded:
            ready = bounded_batch(ready, limit).rows
        until = next_position(ready).first().next_checkpoint
        if until is None:
            return LoadResult(last.batch_id if last else -1, rejected=aside) if aside else None
        run = last.run if last and last.run else f"run-{uuid.uuid4().hex}"
        plan = Position(last.batch_id + 1 if last else 0, False, after, until, run)
        store.write(plan)
    rows = time_range(wanted, plan.position, plan.until, inclusive_end=True)
    loaded = load_batch(rows, job, plan.batch_id, plan.run)
    loaded.rejected += aside
    store.write(Position(plan.batch_id, True, plan.until, run=plan.run))
    return loaded
