"""Continuous ingest: file stream to lake, offsets committed after the sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auditlake.functions.temporal import SAFETY_LAG_MINUTES
from auditlake.sources.raw import require_utc
from auditlake.streaming.loading import LoadJob, LoadResult, load_batch

ARRIVED = "_arrived"


def ingest_stream(
    events: DataFrame,
    job: LoadJob,
    checkpoint: str,
    on_batch: Callable[[LoadResult], None] | None = None,
    load: Callable[[DataFrame, LoadJob, int, str], LoadResult] | None = None,
) -> StreamingQuery:
    """Read what is there since the checkpoint, load it, stop.

    Spark commits a batch's offsets once ``load_batch`` has returned. After a crash
    in between, the same files come again under the same batch id and replace their
    own leaves, so each event lands once.

    Leaves are named after the stream, by the id that Spark keeps in the checkpoint, so
    several streams and runs can write to one lake.

    A micro-batch arrives as computed rows, past any pushdown. A job with ``one_scan``
    reads it once. Otherwise each class folder is a write of its own, and the batch is
    kept on executor disks meanwhile; its size is bounded by the source, and a lost block
    is read again.
    """
    require_utc(events.sparkSession)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # a repeat of the batch has the same name, also after a restart
        run = "stream-" + batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not job.one_scan:
            batch.persist(StorageLevel.DISK_ONLY)
        try:
            loaded = (load or load_batch)(batch, job, batch_id, run)
        finally:
            batch.unpersist()
        if on_batch:
            on_batch(loaded)

    return (
        events.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def without_replays(events: DataFrame, key: str = "id", lag_minutes: int = SAFETY_LAG_MINUTES) -> DataFrame:
    """Drop events of a stream that are delivered again within the late-data allowance.

    The allowance runs from the arrival of an event, that is the clock of its micro-batch,
    which Spark keeps with the offsets: so no event ever comes behind the watermark and is
    lost, a batch that is repeated is the same again, and the ids of one allowance are all
    that is kept as state. Events without the key are no replays of each other and pass.
    """
    known = events.filter(F.col(key).isNotNull()).withColumn(ARRIVED, F.current_timestamp())
    first = known.withWatermark(ARRIVED, f"{lag_minutes} minutes").dropDuplicatesWithinWatermark([key])
    return first.drop(ARRIVED).unionByName(events.filter(F.col(key).isNull()))
