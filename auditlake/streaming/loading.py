"""Load mapped events into the lake: every class to its folder, bad events aside."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.sqltext import literal
from auditlake.functions.temporal import event_day, instant
from auditlake.operators.filters import is_empty
from auditlake.operators.metrics import observed
from auditlake.operators.paging import append_pages
from auditlake.plans.compiler import CompiledMapping, Hook, compile_mapping
from auditlake.plans.mapping import EventMapping
from auditlake.sources.catalog import add_leaves, ensure_table, leaves_of, table_name
from auditlake.sources.files import exists
from auditlake.sources.lake import (
    BATCH_KEY,
    Tenant,
    routes,
    tenant_columns,
    with_partition_keys,
    write_lake,
    write_lake_once,
)
from auditlake.sources.raw import require_utc, scan_table
from auditlake.streaming.compaction import SMALL_BYTES, Compacted, already_merged, compact

REJECTED_FOLDER = "rejected"


@dataclass(frozen=True)
class LoadJob:
    """What to load where. ``on_bad`` is ``fail`` or ``side``.

    With ``one_scan`` all classes are written in one pass over the raw events, below
    ``class_name=`` folders; without it each goes to its own folder in a pass of its own.
    With a ``database`` a load keeps a catalog table of each class, named after it.
    """

    mapping: EventMapping
    root: str
    tenant: Tenant
    time_paths: Collection[str] = ("time",)
    source: str = "identity"
    on_bad: str = "fail"
    cluster_on: tuple[str, ...] = ("eventDay",)
    variant_column: str | None = None
    target_types: Mapping[str, str] | None = None
    hooks: Mapping[str, Hook] | None = None
    ignore_offset: bool = False
    one_scan: bool = True
    database: str | None = None

    def created_sql(self, record: bool) -> str:
        """Creation time in a raw event, or in the ``data`` of a record."""
        if self.variant_column:
            column = "data" if record else self.variant_column
            return f"try_variant_get(`{column}`, '\\u0024.created', 'string')"
        return "data.created" if record else "created"

    def location(self, class_name: str) -> str:
        return f"{self.root.rstrip('/')}/{routes(self.source)[class_name]}"

    def shared_location(self) -> str:
        return f"{self.root.rstrip('/')}/ext/{self.source}"

    def rejected_location(self) -> str:
        return f"{self.root.rstrip('/')}/{REJECTED_FOLDER}"

    def compiled(self, raw: DataFrame, class_name: str | None = None) -> CompiledMapping:
        return compile_mapping(
            self.mapping,
            raw,
            class_name,
            variant_column=self.variant_column,
            time_paths=self.time_paths,
            target_types=self.target_types,
            hooks=self.hooks,
            ignore_offset=self.ignore_offset,
        )


@dataclass
class LoadResult:
    """Rows written by class, put aside, and conditions that took no branch for want of a
    defined test; a retried task may count the last of these twice."""

    batch_id: int
    per_class: dict[str, int] = field(default_factory=dict)
    rejected: int = 0
    undecided: int = 0

    @property
    def transformed(self) -> int:
        return sum(self.per_class.values())


def load_batch(raw: DataFrame, job: LoadJob, batch_id: int, run: str = "run") -> LoadResult:
    """Write one batch of raw events; repeating it leaves the lake unchanged.

    ``run`` names the source of batch ids; two that write to one lake need two names. A
    failure propagates, so the caller does not move its position. Events without a type
    or a usable day go to the side table.
    """
    require_utc(raw.sparkSession)
    loaded = load_in_one_scan(raw, job, batch_id, run) if job.one_scan else _load_by_class(raw, job, batch_id, run)
    if job.database:
        name_leaves(raw, job, [c for c, n in loaded.per_class.items() if n], f"{run}-{batch_id}")
    return loaded


def compact_days(spark: SparkSession, job: LoadJob, before: str, small_bytes: int = SMALL_BYTES) -> Compacted:
    """Merge the small leaves of the days before ``before`` that ``job`` wrote in one scan."""
    root = job.shared_location()
    folders = {c: f"{root}/class_name={c}" for c in job.mapping.classes()}
    done = compact(spark, root, folders, job.tenant, before, small_bytes)
    if job.database and done.leaves:
        for class_name in folders:
            if spark.catalog.tableExists(f"{job.database}.{class_name}"):
                spark.sql(f"MSCK REPAIR TABLE {table_name(job.database, class_name)} SYNC PARTITIONS")
    return done


def name_leaves(raw: DataFrame, job: LoadJob, classes: Collection[str], batch: str) -> None:
    """Make the leaves that a batch wrote known to the tables of its classes."""
    spark = raw.sparkSession
    shared = job.compiled(raw).transform(raw).schema if job.one_scan else None
    for class_name in classes:
        if shared is not None:
            record = T.StructType([f for f in shared.fields if f.name != "class_name"])
            path = f"{job.shared_location()}/class_name={class_name}"
        else:
            record, path = job.compiled(raw, class_name).transform(raw).schema, job.location(class_name)
        ensure_table(spark, job.database, class_name, path, record)
        add_leaves(spark, job.database, class_name, job.tenant, leaves_of(spark, path, job.tenant, batch), batch)


def _load_by_class(raw: DataFrame, job: LoadJob, batch_id: int, run: str) -> LoadResult:
    written = write_classes(raw, job, f"{run}-{batch_id}")
    suspects = [c for c, done in written.items() if done.suspect]
    rejected = _write_rejected(rejected_events(raw, job, suspects), job, f"{run}-{batch_id}")
    undecided = sum(done.undecided for done in written.values())
    return LoadResult(batch_id, {c: done.rows for c, done in written.items()}, rejected, undecided)


@dataclass(frozen=True)
class Written:
    """Rows of a class that were written, whether events without a usable day may have been
    left out, and conditions without a defined test."""

    rows: int
    suspect: bool
    undecided: int


def write_classes(raw: DataFrame, job: LoadJob, batch: str | None = None) -> dict[str, Written]:
    """Map the events of each class and write them to its folder.

    Each class reads its own types only. The classes are independent jobs: the next
    one fills the cluster while the last tasks of another run.
    """

    def write_class(class_name: str) -> Written:
        compiled = job.compiled(raw, class_name)
        open_tests = Observation()
        read = raw.observe(open_tests, F.sum(compiled.undecided()).alias("undecided")) if compiled.undecided_sql else raw
        records = compiled.transform(read, job.on_bad)
        keyed = with_partition_keys(records, job.tenant, job.created_sql(record=True))
        seen = Observation()
        keyed = keyed.observe(seen, F.count_if(F.col("eventDay").isNull()).alias("dayless"))
        counts = write_lake(
            keyed.filter("eventDay IS NOT NULL"),
            job.location(class_name),
            cluster_on=job.cluster_on,
            batch=batch,
        )
        # A retried task may count twice, which still tells none from some. Without
        # a count every row may have been filtered out.
        suspect = (observed(seen) or {}).get("dayless") != 0
        undecided = (observed(open_tests) or {}).get("undecided") or 0 if compiled.undecided_sql else 0
        return Written((observed(counts) or {}).get("transformed", 0), suspect, undecided)

    classes = job.mapping.classes()
    with ThreadPoolExecutor(len(classes)) as pool:
        run = inheritable_thread_target(raw.sparkSession)(write_class)
        return dict(zip(classes, pool.map(run, classes), strict=True))


def load_in_one_scan(raw: DataFrame, job: LoadJob, batch_id: int, run: str = "run") -> LoadResult:
    """Like :func:`load_batch`, but all classes go to ``class_name=`` folders in one job.

    The raw events are read and mapped once, to the record shape all classes share. What
    may have to go to the side table is counted in that pass; only if there is something
    are the events read again to find it.
    """
    require_utc(raw.sparkSession)
    compiled = job.compiled(raw)
    no_type = F.expr(f"{compiled.type_sql} IS NULL")
    typed, unmapped = Observation(), Observation()
    read = raw.observe(typed, F.count_if(no_type).alias("untyped"), F.sum(compiled.undecided()).alias("undecided"))
    set_aside = job.on_bad == "side" and compiled.bad is not None
    records = compiled.transform(read, job.on_bad, unmapped if set_aside else None)
    keyed = with_partition_keys(records, job.tenant, job.created_sql(record=True))
    seen = Observation()
    keyed = keyed.observe(seen, F.count_if(F.col("eventDay").isNull()).alias("dayless")).filter("eventDay IS NOT NULL")
    # days of this batch that a compaction has merged hold its rows already
    merged = already_merged(raw.sparkSession, job.shared_location(), job.tenant, f"{run}-{batch_id}")
    if merged is not None:
        keyed = keyed.join(F.broadcast(merged), ["class_name", "eventDay"], "left_anti")
    written = write_lake_once(keyed, job.shared_location(), batch=f"{run}-{batch_id}")
    suspects = [] if (observed(seen) or {}).get("dayless") == 0 else job.mapping.classes()
    read_counts = observed(typed) or {}
    aside = suspects or read_counts.get("untyped") != 0 or (set_aside and (observed(unmapped) or {}).get("bad") != 0)
    rejected = _write_rejected(rejected_events(raw, job, suspects), job, f"{run}-{batch_id}") if aside else 0
    counts = observed(written) or {}
    per_class = {c: counts.get(c, 0) for c in job.mapping.classes()}
    return LoadResult(batch_id, per_class, rejected, read_counts.get("undecided") or 0)


def rejected_events(raw: DataFrame, job: LoadJob, suspects: Collection[str] | None = None) -> DataFrame:
    """``(event, reason)`` of the events that reach no class folder for a fault of theirs.

    Events without a usable day are looked for among the classes in ``suspects``
    only, all if None, since that search has to read every event of the class.
    """
    everything = job.compiled(raw)
    parts = [everything.untyped(raw)]
    if job.on_bad == "side" and (unmappable := everything.unmappable(raw)) is not None:
        parts.append(unmappable)
    no_day = event_day(job.created_sql(record=False)).isNull()
    for class_name in job.mapping.classes() if suspects is None else suspects:
        faulty = job.compiled(raw, class_name).keep(raw).filter(no_day)
        reason = F.lit("event has no usable day").alias("reason")
        parts.append(faulty.select(F.to_json(F.struct("*")).alias("event"), reason))
    return append_pages(*parts)


def _write_rejected(rejected: DataFrame, job: LoadJob, batch: str) -> int:
    """Add to the side table, below the tenant and the batch."""
    counted = Observation()
    (
        tenant_columns(rejected.observe(counted, F.count(F.lit(1)).alias("n")), job.tenant)
        .withColumn(BATCH_KEY, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("region", "accountId", BATCH_KEY)
        .parquet(job.rejected_location())
    )
    return (observed(counted) or {}).get("n", 0)


def write_unreadable(source: DataFrame, job: LoadJob) -> int:
    """Put events that no time range can pick, for want of a type or a time, aside.

    Every one goes to the side table once, however often this runs: those that are there
    already are left out. Gives the number added.
    """
    created = instant(job.created_sql(record=False))
    type_sql = job.compiled(source).type_sql
    wanted = ", ".join(literal(t) for t in job.mapping.wanted_types)
    bad = source.filter(f"{type_sql} IS NULL OR {type_sql} IN ({wanted})").filter(
        F.expr(f"{type_sql} IS NULL") | created.isNull()
    )
    reason = F.when(F.expr(f"{type_sql} IS NULL"), "event has no type").otherwise("event has no usable day")
    bad = bad.select(F.to_json(F.struct("*")).alias("event"), reason.alias("reason")).distinct()
    if exists(source.sparkSession, job.rejected_location()):
        known = source.sparkSession.read.schema("event string, region string, accountId string").parquet(
            job.rejected_location()
        )
        own = (F.col("region") == job.tenant.region) & (F.col("accountId") == job.tenant.account_id)
        bad = bad.join(known.filter(own).select("event"), "event", "left_anti")
    if bad.isEmpty():
        return 0
    return _write_rejected(bad, job, f"unreadable-{uuid.uuid4().hex}")


def load_tables(spark: SparkSession, database: str, tables: Mapping[str, str], job: LoadJob) -> dict[str, int]:
    """Load staged class tables of the catalog into the lake; gives the rows of each class.

    ``tables`` names the table of each class. Its records are appended to the route of
    the class with day and tenant; a table without rows is passed over. Records without
    a usable day go to the side table.
    """
    require_utc(spark)
    loaded = {}
    for class_name, name in tables.items():
        staged = scan_table(spark, database, name)
        if is_empty(staged):
            loaded[class_name] = 0
            continue
        keyed = with_partition_keys(staged, job.tenant, job.created_sql(record=True))
        seen = Observation()
        keyed = keyed.observe(seen, F.count_if(F.col("eventDay").isNull()).alias("dayless"))
        counts = write_lake(
            keyed.filter("eventDay IS NOT NULL"), job.location(class_name), cluster_on=job.cluster_on
        )
        loaded[class_name] = (observed(counts) or {}).get("transformed", 0)
        if (observed(seen) or {}).get("dayless") != 0:
            dayless = staged.filter(event_day(job.created_sql(record=True)).isNull()).select(
                F.to_json(F.struct("*")).alias("event"), F.lit("event has no usable day").alias("reason")
            )
            _write_rejected(dayless, job, f"staged-{uuid.uuid4().hex}")
    return loaded
