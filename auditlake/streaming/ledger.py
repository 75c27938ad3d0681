"""Batch ingest by file: each raw file is opened until all of it has been taken, then never.

The ledger is a table of the files that runs have read. A run lists the raw folder, joins
the listing with the ledger, and opens what is new or was left with events that had not
settled. So history is not read again, and an event that arrives behind the position, in a
new file, is taken like any other: the position is kept for each file.

Files are told apart by path, size and time of change. They are expected to be complete when
they appear; one that is replaced is a new file. Before it loads, a run stores which files it
is to read and up to which time; a run that finds such a plan without its commit repeats it
under the same names, so a crash neither loses nor doubles events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.sqltext import in_list, literal
from auditlake.functions.temporal import SAFETY_LAG_MINUTES, instant
from auditlake.operators.filters import DEFAULT_START, format_instant, parse_instant, upper_bound
from auditlake.operators.paging import bounded_batch
from auditlake.sources.files import exists
from auditlake.sources.raw import RAW_EVENT, require_utc
from auditlake.streaming.history import RunHistory
from auditlake.streaming.loading import LoadJob, LoadResult, load_batch
from auditlake.streaming.position import Position, PositionStore

FILE_COLUMN = "_raw_file"
FILES = "path string, name string, size bigint, changed bigint, taken string, pending boolean, batch bigint"


@dataclass(frozen=True)
class RawFiles:
    """A folder of raw events and how to read it.

    ``shape`` turns what is stored into raw events, row by row, and has to keep the columns
    that it does not know. With ``variant_column`` files hold JSON lines of open shape.
    """

    path: str
    fmt: str = "parquet"
    schema: T.StructType | None = RAW_EVENT
    glob: str | None = None
    shape: Callable[[DataFrame], DataFrame] | None = None
    variant_column: str | None = None

    def listed(self, spark: SparkSession) -> DataFrame:
        """``path, name, size, changed`` of the files; their content is not opened. The name
        is the path as events tell it, which may have escapes."""
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if self.glob:
            reader = reader.option("pathGlobFilter", self.glob)
        changed = F.unix_micros("modificationTime").alias("changed")
        found = reader.load(self.path)
        return found.select("path", F.col("_metadata.file_path").alias("name"), F.col("length").alias("size"), changed)

    def scan(self, spark: SparkSession, paths: Sequence[str]) -> DataFrame:
        """Events of some files, with the file each is from."""
        if self.variant_column:
            stored = spark.read.option("singleVariantColumn", self.variant_column).json(list(paths))
        else:
            reader = spark.read.format(self.fmt)
            stored = (reader.schema(self.schema) if self.schema else reader).load(list(paths))
        stored = stored.withColumn(FILE_COLUMN, F.col("_metadata.file_path"))
        return self.shape(stored) if self.shape else stored


class FileLedger:
    """Files read, by batch, below ``<path>/files``; plans and commits below ``<path>/state``."""

    def __init__(self, spark: SparkSession, path: str, store: PositionStore | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.store = store or PositionStore(spark, f"{self.path}/state")

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/run={batch_id}"

    def read(self) -> DataFrame:
        """The last state of every file that was read."""
        schema = T.StructType.fromDDL(FILES)
        if not exists(self.spark, f"{self.path}/files"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/files")
        last = F.max_by(F.struct("taken", "pending"), "batch").alias("last")
        states = rows.groupBy("path", "name", "size", "changed").agg(last, F.max("batch").alias("batch"))
        return states.select("path", "name", "size", "changed", "last.taken", "last.pending", "batch")

    def plan(self, files: DataFrame, batch_id: int) -> DataFrame:
        """Store the files a run is to read, with the time up to which each was taken."""
        files = files.withColumn("batch", F.lit(batch_id).cast("bigint"))
        files.coalesce(1).write.mode("overwrite").parquet(self._folder("planned", batch_id))
        return self.planned(batch_id)

    def planned(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(FILES).parquet(self._folder("planned", batch_id))

    def commit(self, files: DataFrame, batch_id: int) -> None:
        files.select(*T.StructType.fromDDL(FILES).fieldNames()).coalesce(1).write.mode("overwrite").parquet(
            self._folder("files", batch_id)
        )


def _unread(files: RawFiles, ledger: FileLedger, until: str) -> DataFrame:
    """Files that are new, and those that were left with events and may now give some."""
    key = ["path", "name", "size", "changed"]
    listed, known = files.listed(ledger.spark), ledger.read()
    new = listed.join(known, key, "left_anti").selectExpr(*key, "CAST(NULL AS STRING) AS taken", "TRUE AS pending")
    left = known.filter(F.col("pending") & (F.col("taken") < F.lit(until)))
    left = left.join(listed, key, "left_semi").select(*key, "taken", "pending")
    return new.unionByName(left)


@dataclass
class _Times:
    """Expressions over raw events: when they were made, and whether they are wanted."""

    job: LoadJob
    type_sql: str

    @property
    def made(self):
        return instant(self.job.created_sql(record=False))

    @property
    def wanted(self):
        return F.expr(f"{self.type_sql} IN {in_list(self.job.mapping.wanted_types)}")

    def settled(self, after: str | None, until: str, start: str):
        """Wanted events of a file that was taken up to ``after``; of a new one also those
        without a type or a usable time, which no range can pick."""
        if after is not None:
            return self.wanted & _within(F.unix_micros(self.made), after, until)
        timeless_or_in_range = _within(F.coalesce(F.unix_micros(self.made), _micros(until)), start, until)
        return F.expr(f"{self.type_sql} IS NULL") | (self.wanted & timeless_or_in_range)


def _micros(text: str) -> Column:
    return F.unix_micros(F.lit(text).cast("timestamp"))


def _within(micros: Column, after: str, until: str) -> Column:
    """Whether a time is later than ``after`` and not than ``until``, told by its distance from
    the middle: two comparisons would parse the text of the time twice. An ``until`` before
    ``after`` gives a negative length, which no distance is below."""
    first, last = _micros(after) + 1, _micros(until)
    return F.abs(micros * 2 - (first + last)) <= last - first


def _instants(text: str) -> str:
    return format_instant(parse_instant(text))


def ingest_files(
    files: RawFiles,
    job: LoadJob,
    ledger: FileLedger,
    now: str,
    *,
    limit: int | str | None = None,
    bounded: bool = False,
    start: str = DEFAULT_START,
    lag_minutes: int = SAFETY_LAG_MINUTES,
    history: RunHistory | None = None,
) -> LoadResult | None:
    """One incremental run over the raw files; None when there is nothing to read.

    Takes every wanted event that has settled and was not taken before; with ``bounded``
    only about ``limit`` of the oldest of these, whole groups of equal times. Events of a
    new file without a type or a usable time go to the side table in the same pass. What
    the run did is added to the ``history`` before it is committed.
    """
    spark = ledger.spark
    require_utc(spark)
    last = ledger.store.read()
    if last is not None and not last.committed:
        plan, chosen = last, ledger.planned(last.batch_id)
    else:
        # events of the very bound have not settled
        until = format_instant(parse_instant(upper_bound(now, lag_minutes)) - timedelta(microseconds=1))
        batch_id = last.batch_id + 1 if last else 0
        chosen = ledger.plan(_unread(files, ledger, until), batch_id)
        if chosen.isEmpty():
            return None
        if bounded:
            until = _bounded_until(_rows(files, job, chosen, until, start), job, limit) or until
        run = last.run if last and last.run else f"files-{uuid.uuid4().hex}"
        plan = Position(batch_id, False, last.position if last else start, until, run)
        ledger.store.write(plan)
    rows = _rows(files, job, chosen, plan.until, start)
    loaded = load_batch(rows.drop(FILE_COLUMN), job, plan.batch_id, plan.run)
    if history is not None:
        history.note(rows.drop(FILE_COLUMN), job, loaded, plan.run)
    ledger.commit(_after(files, job, chosen, plan.until), plan.batch_id)
    ledger.store.write(Position(plan.batch_id, True, plan.until, run=plan.run))
    return loaded


def _paths_by_taken(chosen: DataFrame) -> dict[str | None, list[str]]:
    """Paths of a plan by the time up to which they were taken; the files of one run, which
    Spark lists on the driver as well."""
    paths: dict[str | None, list[str]] = {}
    for row in chosen.select("taken", "path").collect():
        paths.setdefault(row.taken, []).append(row.path)
    return paths


def _rows(files: RawFiles, job: LoadJob, chosen: DataFrame, until: str, start: str) -> DataFrame:
    """What a plan takes of its files."""
    parts = []
    for taken, paths in _paths_by_taken(chosen).items():
        events = files.scan(chosen.sparkSession, paths)
        times = _Times(job, job.compiled(events.drop(FILE_COLUMN)).type_sql)
        parts.append(events.filter(times.settled(taken, until, _instants(start))))
    return reduce(DataFrame.unionByName, parts)


def _bounded_until(rows: DataFrame, job: LoadJob, limit: int | str | None) -> str | None:
    """Time of the last event that a bounded run takes; None where there is no event."""
    made = instant(job.created_sql(record=False))
    times = rows.select(made.alias("at")).filter("at IS NOT NULL")
    end = bounded_batch(times, limit, "at").end.select(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).first()
    return end[0] if end else None


def _after(files: RawFiles, job: LoadJob, chosen: DataFrame, until: str) -> DataFrame:
    """The files of a plan with what is left in them; reads types and times only."""
    spark = chosen.sparkSession
    paths = [p for own in _paths_by_taken(chosen).values() for p in own]
    events = files.scan(spark, paths)
    times = _Times(job, job.compiled(events.drop(FILE_COLUMN)).type_sql)
    left = events.filter(times.wanted & (times.made > F.lit(until).cast("timestamp")))
    left = left.groupBy(F.col(FILE_COLUMN).alias("name")).agg(F.count("*").alias("n_left"))
    taken = F.greatest(F.coalesce("taken", F.lit(until)), F.lit(until))
    return chosen.join(left, "name", "left").select(
        "path", "name", "size", "changed", taken.alias("taken"), F.col("n_left").isNotNull().alias("pending"), "batch"
    )
