"""One runnable query per operator, over the driver's tables.

Every query reads whole tables; a time range or a page appears only where it is the
operator itself. Nested results are flattened to scalar columns.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake import fixtures as fx
from auditlake.functions import nested, open_bodies, temporal, text
from auditlake.operators import filters, lookups, metrics, paging
from auditlake.plans.compiler import compile_mapping
from auditlake.plans.conditions import condition_column
from auditlake.plans.hooks import sql_functions
from auditlake.plans.mapping import EventMapping, load_mapping
from auditlake.sources import discovery, lake, raw as raw_source
from auditlake.sources.local import MAX_BROADCAST_ROWS, local_frame, small
from auditlake.sources.lookups import enums_frame, rules_frame, store_bucketed, terms_frame, types_frame, with_defaults
from auditlake.sources.terms import ENUMS, TERMS
from auditlake.sources.workspace import fresh_folder
from auditlake.streaming.history import RunHistory
from auditlake.streaming.ingest import ingest_stream, without_replays
from auditlake.streaming.ledger import FILE_COLUMN, FileLedger, RawFiles, ingest_files
from auditlake.streaming.loading import LoadJob, LoadResult, compact_days, load_batch, load_tables, write_classes
from auditlake.streaming.position import Position, PositionStore, run_once
from auditlake.streaming.position import clamp_checkpoint as clamp_saved

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
N_TERMS = sum(len(captions) for captions in TERMS.values())
N_ENUMS = sum(len(ids) for ids in ENUMS.values())
SAFETY_NOW = "2024-01-20T12:00:00Z"
CLAMP_NOW = "2024-01-30T12:00:00Z"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_source.scan_events(spark, f"{sf_dir}/events.parquet", schema=EVENTS_SCHEMA)


def raw_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.audit_view(events_of(spark, sf_dir))


def raw_between(spark: SparkSession, sf_dir: str, after: str | None, before: str | None) -> DataFrame:
    """Raw events of a time range. ``created`` is ``ts`` cut to millis, so the same
    range on ``ts`` keeps a superset, and reaches the scan."""
    events = filters.time_range(events_of(spark, sf_dir), after, before, "ts")
    return filters.time_range(fx.audit_view(events), after, before)


def records_of(
    raw: DataFrame, mapping: EventMapping | None = None, targets: Collection[str] | None = None
) -> DataFrame:
    compiled = compile_mapping(mapping or fx.demo_mapping(), raw, time_paths=fx.TIME_PATHS, targets=targets)
    return compiled.transform(raw)


def mapping_of(field_mappings: dict, statics: dict | None = None) -> EventMapping:
    """A mapping with the same rules for every demo type."""
    return load_mapping(
        {
            event_type: {
                "staticValues": {"class_name": rules.class_name, **(statics or {})},
                "fieldMappings": field_mappings,
            }
            for event_type, rules in fx.demo_mapping().types.items()
        },
        TERMS,
        ENUMS,
    )


def flat(records: DataFrame, *more: str | Column) -> DataFrame:
    return records.select(
        "class_name",
        F.col("metadata.version").alias("metadata_version"),
        F.col("metadata.product.name").alias("product_name"),
        "activity_name",
        "activity_id",
        "status",
        "status_id",
        "time",
        F.col("actor.user.name").alias("actor_user_name"),
        F.col("actor.user.type").alias("actor_user_type"),
        F.col("actor.user.type_id").alias("actor_user_type_id"),
        F.col("src.name").alias("src_name"),
        F.col("src.group.name").alias("src_group_name"),
        F.col("src.kind").alias("src_kind"),
        F.col("data.id").alias("id"),
        F.col("data.type").alias("type"),
        F.col("data.created").alias("created"),
        *more,
    )


def counted_types(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Events per mapped type, zero included; at most one row per mapped type."""
    types = types_frame(spark, fx.demo_mapping())
    n_types = len(fx.demo_mapping().types)
    counts = lookups.dispatch(raw.select("type"), types, n_types).groupBy("type").agg(F.count("*").alias("n"))
    counted = types.join(small(counts, n_types), "type", "left")
    return counted.select("type", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_events"))


def with_classes(spark: SparkSession, raw: DataFrame) -> DataFrame:
    return lookups.dispatch(raw, types_frame(spark, fx.demo_mapping()), len(fx.demo_mapping().types))


def with_caption(spark: SparkSession, raw: DataFrame) -> DataFrame:
    terms = terms_frame(spark, TERMS)
    return lookups.normalize_term(raw, terms, "operation", N_TERMS, hit="hit")


def landed(spark: SparkSession, job: LoadJob, raw: DataFrame) -> DataFrame:
    if job.one_scan:
        record = job.compiled(raw).transform(raw).schema
        keys = ("class_name", *lake.PARTITION_KEYS)
        return flat(lake.read_lake(spark, job.shared_location(), record, keys), *lake.PARTITION_KEYS)
    parts = []
    for class_name in job.mapping.classes():
        record = job.compiled(raw, class_name).transform(raw).schema
        parts.append(flat(lake.read_lake(spark, job.location(class_name), record), *lake.PARTITION_KEYS))
    return paging.append_pages(*parts)


# --- sources and sinks ----------------------------------------------------------


@query
def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(spark, sf_dir)


@query
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"auditlake_{zlib.crc32(sf_dir.encode()):x}"
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{fresh_folder(spark, 'catalog')}'"
    )
    lake.register_table(spark, database, "events", f"{sf_dir}/events.parquet")
    return raw_source.scan_table(spark, database, "events")


@query
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = records_of(raw_of(spark, sf_dir))
    folder = fresh_folder(spark, "jsonl")
    lake.write_jsonl(records, folder)
    return flat(lake.read_jsonl(spark, folder, records.schema))


@query
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    body = F.to_json(
        F.struct("id", "type", "created", "operation", "status", F.length("operation").alias("size"), "attributes.tags")
    )
    staged = with_classes(spark, raw.select("type", body.alias("json")))
    return raw_source.infer_schema(staged)


@query
def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "lake"), fx.TENANT, one_scan=False)
    write_classes(raw, job)
    return landed(spark, job, raw)


@query
def one_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "one-scan"), fx.TENANT)
    load_batch(raw, job, 0)
    return landed(spark, job, raw)


@query
def table_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class tables of the catalog, staged as JSON lines, to their routes in the lake."""
    raw = raw_of(spark, sf_dir)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "from-tables"), fx.TENANT, one_scan=False)
    folder = fresh_folder(spark, "staged")
    database = f"auditlake_staged_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{folder}-catalog'")
    tables = {}
    for class_name in job.mapping.classes():
        records = job.compiled(raw, class_name).transform(raw)
        tables[class_name] = f"staged_{class_name}"
        records.write.mode("overwrite").json(f"{folder}/{class_name}")
        spark.catalog.createTable(
            f"{database}.{tables[class_name]}", path=f"{folder}/{class_name}", source="json", schema=records.schema
        )
    load_tables(spark, database, tables, job)
    return landed(spark, job, raw)


@query
def route_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = records_of(raw_of(spark, sf_dir), targets=("data",))
    keyed = lake.with_partition_keys(records, fx.TENANT)
    routed = keyed.withColumn("location", lake.route_of(F.col("class_name")))
    path = F.format_string(
        "%s/region=%s/accountId=%s/eventDay=%s", "location", "region", "accountId", "eventDay"
    )
    return routed.groupBy("class_name", "location", path.alias("path")).agg(F.count("*").alias("n_events"))


@query
def file_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the lake folder that the files they were written to lie in."""
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "files"), fx.TENANT, one_scan=False)
    write_classes(raw_of(spark, sf_dir), job)
    parts = []
    for class_name in job.mapping.classes():
        files = lake.read_lake(spark, job.location(class_name), T.StructType(), with_path=True)
        parts.append(files.select(lake.file_route(F.col("path"), job.root).alias("route")))
    return paging.append_pages(*parts).groupBy("route").agg(F.count("*").alias("n_events"))


@query
def terms_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = terms_frame(spark, TERMS)
    used = raw_of(spark, sf_dir).select("type", F.col("operation").alias("term"))
    # matched first, so the counts have at most one row per term
    counts = (
        used.join(small(terms.select("type", "term"), N_TERMS), ["type", "term"], "left_semi")
        .groupBy("type", "term")
        .agg(F.count("*").alias("n"))
    )
    joined = terms.join(small(counts, N_TERMS), ["type", "term"], "left")
    return joined.select("type", "term", "caption", F.coalesce("n", F.lit(0)).alias("n_events"))


@query
def enum_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    enums = enums_frame(spark, ENUMS)
    used = with_caption(spark, with_classes(spark, raw_of(spark, sf_dir))).select(
        F.col("class_name").alias("object"), F.lit("activity_id").alias("attribute"), "caption"
    )
    key = ["object", "attribute", "caption"]
    counts = (
        used.join(small(enums.select(*key), N_ENUMS), key, "left_semi").groupBy(*key).agg(F.count("*").alias("n"))
    )
    joined = enums.join(small(counts, N_ENUMS), key, "left")
    return joined.select(
        *key,
        text.enum_key(F.col("object"), F.col("attribute")).alias("key"),
        "id",
        F.coalesce("n", F.lit(0)).alias("n_events"),
    )


@query
def mapping_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_frame(spark, fx.demo_mapping())
    counts = counted_types(spark, raw_of(spark, sf_dir))
    return rules.join(small(counts, len(fx.demo_mapping().types)), "type")


# --- filters and predicates -----------------------------------------------------


@query
def incremental_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = filters.upper_bound(fx.NOW)
    return raw_between(spark, sf_dir, fx.CHECKPOINT, before).select("id", "type", "created")


@query
def type_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = filters.of_types(raw_of(spark, sf_dir), fx.demo_mapping().wanted_types)
    return wanted.select("id", "type", "created")


@query
def drop_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = types_frame(spark, fx.demo_mapping())
    kept = filters.drop_unmapped(raw_of(spark, sf_dir), mapped, len(fx.demo_mapping().types))
    return kept.select("id", "type")


@query
def cond_in_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    return raw.select(
        "id",
        condition_column("user_1 in actor.name", raw).alias("in_actor"),
        condition_column("source in attributes.sourceName", raw).alias("lower_in_source"),
        condition_column("E in operation", raw).alias("in_operation"),
    )


@query
def cond_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    return raw.select(
        "id",
        condition_column("user_1 not in actor.name", raw).alias("not_in_actor"),
        condition_column("t1 not in attributes.tags", raw).alias("not_in_tags"),
        condition_column("A not in operation", raw).alias("not_in_operation"),
    )


@query
def cond_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    return raw.select(
        "id",
        condition_column("t1 in attributes.tags", raw).alias("has_t1"),
        condition_column("t in attributes.tags", raw).alias("has_t"),
        condition_column("view in attributes.tags", raw).alias("has_view"),
    )


@query
def cond_in_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_of(spark, sf_dir).selectExpr(
        "event_id AS id",
        "from_json(props, 'map<string,int>') AS as_map",
        "parse_json(props) AS as_variant",
        """CASE WHEN user_id % 3 = 0 THEN parse_json(concat('["', event_type, '"]'))
                WHEN user_id % 3 = 1 THEN parse_json(concat('"', event_type, '"'))
                ELSE parse_json(concat('{"', event_type, '": 1}')) END AS mixed""",
        "named_struct('name', CASE WHEN user_id % 7 <> 0 THEN 'x' END, 'kind', event_type) AS actor",
    )
    return events.select(
        "id",
        condition_column("k in as_map", events).alias("map_has_k"),
        condition_column("j in as_map", events).alias("map_has_j"),
        condition_column("k in as_variant", events).alias("variant_has_k"),
        condition_column("view in mixed", events).alias("mixed_has_view"),
        condition_column("vi in mixed", events).alias("mixed_has_vi"),
        condition_column("name in actor", events).alias("struct_has_name"),
    )


@query
def cond_system_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_of(spark, sf_dir).selectExpr(
        "event_id AS id",
        "CASE WHEN user_id % 3 = 0 THEN '' WHEN user_id % 3 = 1 THEN event_type END AS word",
        "user_id % 4 AS number",
        "user_id % 2 = 0 AS flag",
        "CASE WHEN user_id % 2 = 0 THEN array() ELSE array(event_type) END AS items",
        "CASE WHEN user_id % 2 = 0 THEN map() ELSE map(event_type, 1) END AS entries",
    )
    return events.select(
        "id",
        *[
            condition_column(f"System in {name}", events).alias(f"system_in_{name}")
            for name in ("word", "number", "flag", "items", "entries", "missing")
        ],
        condition_column("Sys not in word", events).alias("sys_not_in_word"),
    )


@query
def null_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"actor,name": [{"target_field": "who"}], "actor,missing": [{"target_field": "never"}]}
    mapping = mapping_of(rules, {"who": "nobody", "never": "kept"})
    return records_of(raw_of(spark, sf_dir), mapping).select("data.id", "who", "never")


@query
def blank_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_frame(spark, fx.demo_mapping())
    counts = counted_types(spark, raw_of(spark, sf_dir))
    blank = rules.filter(text.is_blank(F.col("target")))
    joined = blank.join(small(counts, len(fx.demo_mapping().types)), "type")
    return joined.select("type", "source", "term", "n_events")


@query
def prune_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested_events = events_of(spark, sf_dir).selectExpr(
        "event_id AS id",
        "map('click', 'by key', 'kind', event_type, 'none', CAST(NULL AS STRING)) AS entries",
        "array(event_type, CAST(NULL AS STRING), 'kept') AS items",
        "named_struct('click', user_id, 'kind', event_type, 'user_id', user_id) AS object",
        "array(named_struct('kind', event_type, 'click', 1)) AS objects",
    )
    pruned = nested.prune_frame(nested_events, "click")
    return pruned.select(
        "id",
        F.size("entries").alias("n_entries"),
        F.try_element_at("entries", F.lit("kind")).alias("entry_kind"),
        F.map_contains_key("entries", "none").alias("keeps_null_entry"),
        F.array_join("items", ",", "-").alias("items"),
        F.to_json("object").alias("object"),
        F.to_json("objects").alias("objects"),
    )


@query
def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted_types(spark, raw_of(spark, sf_dir))
    return counts.withColumn("is_empty", F.col("n_events") == 0)


@query
def https_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.filter(text.is_https(F.col("url"))).select("page_id", "url")


# --- projections and record shaping ---------------------------------------------


@query
def nested_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_of(spark, sf_dir).selectExpr(
        "event_id AS id",
        "named_struct('name', event_type, 'inner', named_struct('user', user_id)) AS actor",
        """parse_json(concat('{"a": {"b": "', event_type, '", "c.d": ', user_id, '}, "p": ', props, '}'))
           AS body""",
    )
    declared = nested.StructBody(events.schema)
    opened = nested.VariantBody("body")
    return events.select(
        "id",
        nested.nested_get(declared, ["actor", "inner", "user"]).alias("struct_user"),
        nested.nested_get(declared, ["actor", "name", "deeper"], "string").alias("below_text"),
        nested.nested_get(opened, ["a", "b"]).alias("variant_b"),
        nested.nested_get(opened, ["a", "c.d"], "bigint").alias("dotted_key"),
        nested.nested_get(opened, ["a", "b", "c"]).alias("below_scalar"),
        nested.nested_get(opened, ["p", "k"], "int").alias("variant_k"),
    )


@query
def nested_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_of(spark, sf_dir)
    placed = nested.nested_set(
        raw,
        {"id": "id", "who.user.name": "actor.name", "who.user.tag": "attributes.tags[0]", "who.source": "attributes.sourceName", "gap.name": "actor.name"},
    )
    return placed.select(
        "id",
        F.col("who.user.name").alias("user_name"),
        F.col("who.user.tag").alias("user_tag"),
        F.col("who.source").alias("source"),
        F.to_json("gap").alias("gap"),
    )


@query
def wrap_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(raw_of(spark, sf_dir), targets=("data",)).select(
        "data.id",
        "data.type",
        "data.created",
        "data.operation",
        "data.status",
        F.col("data.actor.name").alias("actor_name"),
        F.col("data.attributes.sourceName").alias("source_name"),
        F.array_join("data.attributes.tags", ",").alias("tags"),
    )


@query
def static_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = mapping_of(
        {}, {"metadata": {"version": "1.1", "product": {"name": "It's \"Audit\" ${user.name}"}}, "severity_id": 1, "ok": True}
    )
    return records_of(raw_of(spark, sf_dir), mapping).select(
        F.col("data.id").alias("id"),
        "class_name",
        F.col("metadata.version").alias("version"),
        F.col("metadata.product.name").alias("product"),
        "severity_id",
        "ok",
    )


@query
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = mapping_of(
        {
            "operation": [{"target_field": "activity.name"}],
            "attributes,sourceName": [{"target_field": "src.name"}],
            "attributes.sourceName": [{"target_field": "src.literal"}],
        }
    )
    return records_of(raw_of(spark, sf_dir), mapping).select(
        F.col("data.id").alias("id"),
        F.col("activity.name").alias("activity"),
        F.col("src.name").alias("src_name"),
        F.col("src.literal").alias("src_literal"),
    )


@query
def first_match_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = mapping_of(
        {
            "ignored": [
                {
                    "target_field": "picked",
                    "conditions": [
                        {"condition": "user_1 in actor.name", "source_field": "attributes.missing"},
                        {"condition": "user_ in actor.name", "source_field": "actor.name"},
                        {"condition": "t2 not in attributes.tags", "source_field": "attributes.sourceName"},
                    ],
                }
            ]
        }
    )
    return records_of(raw_of(spark, sf_dir), mapping).select("data.id", "picked")


@query
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = mapping_of(
        {
            "actor,name": [
                {"target_field": {"USER": "user.type", "PASSED": "user.outcome"}, "transform": "normalize"},
                {"target_field": {"a": "copy.one", "b": "copy.two", "c": " "}},
            ]
        }
    )
    return records_of(raw_of(spark, sf_dir), mapping).select(
        F.col("data.id").alias("id"),
        F.col("user.type").alias("user_type"),
        F.col("user.outcome").alias("user_outcome"),
        F.col("copy.one").alias("copy_one"),
        F.col("copy.two").alias("copy_two"),
    )


@query
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = mapping_of(
        {
            "operation": [{"target_field": "label", "conditions": [{"condition": "E in operation", "source_field": "operation"}]}],
            "status": [{"target_field": "other"}],
            "actor,name": [{"target_field": "label"}, {"target_field": "other"}],
        },
        {"label": "static"},
    )
    return records_of(raw_of(spark, sf_dir), mapping).select("data.id", "label", "other")


@query
def event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(spark, sf_dir).select("id", temporal.event_day("created").alias("eventDay"))


@query
def tenant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.tenant_columns(raw_of(spark, sf_dir).select("id"), fx.TENANT)


@query
def transform_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(records_of(raw_of(spark, sf_dir)))


@query
def unlike_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types whose targets, conditions, prefixes and static types differ."""
    records = records_of(raw_of(spark, sf_dir), fx.unlike_mapping())
    return records.select("data.id", "class_name", "label", "note", "level")


@query
def rule_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = with_defaults(rules_frame(spark, fx.demo_mapping())).filter("transform = 'normalize'")
    counts = counted_types(spark, raw_of(spark, sf_dir))
    applied = rules.join(small(counts, len(fx.demo_mapping().types)), "type")
    return applied.groupBy("output_type", "concat_string").agg(
        F.count("*").alias("n_rules"), F.sum("n_events").alias("n_applications")
    )


# --- lookups --------------------------------------------------------------------


@query
def normalize_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_caption(spark, raw_of(spark, sf_dir)).select("id", "type", "operation", "caption")


@query
def normalize_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    captioned = with_caption(spark, raw_of(spark, sf_dir))
    return captioned.select("id", lookups.prefixed(F.col("caption"), "Job ").alias("prefixed"))


@query
def enum_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_classes(spark, raw_of(spark, sf_dir)).withColumns(
        {
            "attribute": F.expr("CASE WHEN type = 'AUTH' THEN 'actor.user.type_id' ELSE 'activity_id' END"),
            "caption": F.expr(
                "CASE WHEN type = 'AUTH' THEN concat('Actor ', initcap(operation)) ELSE initcap(operation) END"
            ),
        }
    )
    found = lookups.enum_id(
        events, enums_frame(spark, ENUMS), F.col("class_name"), F.col("attribute"), "caption", N_ENUMS
    )
    return found.select("id", "class_name", "attribute", "caption", "enum_id")


@query
def type_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_classes(spark, raw_of(spark, sf_dir)).select("id", "type", "class_name")


@query
def normalize_to_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_classes(spark, raw_of(spark, sf_dir))
    terms = terms_frame(spark, TERMS)
    captioned = lookups.normalize_term(events, terms, "status", N_TERMS)
    prefix = F.when(F.col("type") == "SYSTEM_CONFIG", "Job ").otherwise("")
    captioned = captioned.withColumn("caption", lookups.prefixed(F.col("caption"), prefix))
    found = lookups.enum_id(
        captioned, enums_frame(spark, ENUMS), F.col("class_name"), F.lit("status_id"), "caption", N_ENUMS, output="status_id"
    )
    return found.select("id", "caption", "status_id")


# --- aggregations ---------------------------------------------------------------


@query
def events_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.per_class(records_of(raw_of(spark, sf_dir), targets=()))


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    received, done = Observation(), Observation()
    raw = raw_of(spark, sf_dir).observe(received, F.count(F.lit(1)).alias("received"))
    records = records_of(raw).observe(done, *metrics.class_counts())
    records.write.format("noop").mode("overwrite").save()
    counts = {**received.get, **done.get}
    schema = ", ".join(f"{name} bigint" for name in counts)
    return local_frame(spark, [tuple(counts.values())], schema)


@query
def next_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = filters.upper_bound(fx.NOW)
    return metrics.next_position(raw_between(spark, sf_dir, fx.CHECKPOINT, before))


@query
def total_and_caught_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = raw_between(spark, sf_dir, fx.CHECKPOINT, filters.upper_bound(fx.NOW))
    wanted = filters.of_types(ready, fx.demo_mapping().wanted_types)
    return metrics.total_and_caught_up(wanted, None)


@query
def lookup_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.lookup_coverage(with_caption(spark, raw_of(spark, sf_dir)), "operation")


# --- sorts, limits, sets --------------------------------------------------------


@query
def sorted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.sorted_events(raw_of(spark, sf_dir).select("id", "type", "created"))


@query
def page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(raw_of(spark, sf_dir).select("id", "type", "created"), "not a number", 250)


@query
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(raw_of(spark, sf_dir).select("id", "type", "created"), 300, 600, shallow=100)


@query
def page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_of(spark, sf_dir).select("id", "type", "created")
    return paging.page_after(rows, ("2024-01-15T00:00:00.000Z", ""), 500)


@query
def append_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = raw_between(spark, sf_dir, None, "2024-01-20T00:00:00.000Z")
    second = raw_between(spark, sf_dir, fx.CHECKPOINT, None)
    return paging.append_pages(first, second).select("id", "type", "created")


# --- scalar functions -----------------------------------------------------------


@query
def to_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = raw_of(spark, sf_dir).selectExpr(
        "id",
        """CASE CAST(id AS BIGINT) % 6
             WHEN 0 THEN created
             WHEN 1 THEN concat(left(created, 19), 'Z')
             WHEN 2 THEN concat(left(created, 19), '+02:00')
             WHEN 3 THEN '12:30'
             WHEN 4 THEN operation
             ELSE left(created, 4) END AS spelled""",
    )
    return spelled.select(
        "id",
        temporal.to_epoch("spelled").alias("epoch"),
        temporal.to_epoch("spelled", ignore_offset=True).alias("wall_epoch"),
    )


@query
def epoch_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = raw_of(spark, sf_dir).selectExpr(
        "id",
        "created AS time",
        "named_struct('at', created, 'op', operation, 'deep', named_struct('at', created)) AS span",
        "array(named_struct('at', created)) AS history",
        "named_struct('time', created) AS data",
    )
    paths = [("time",), ("span", "at"), ("span", "deep", "at"), ("history", "at"), ("data", "time")]
    done = temporal.epoch_all_fields(record, paths)
    return done.select(
        "id",
        "time",
        F.col("span.at").alias("span_at"),
        F.col("span.op").alias("span_op"),
        F.col("span.deep.at").alias("span_deep_at"),
        F.col("history")[0]["at"].alias("history_at"),
        F.col("data.time").alias("data_time"),
    )


@query
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    parent, leaf = text.path_tail(F.col("url"))
    comma_parent, comma_leaf = text.path_tail(F.col("url"), ",")
    return pages.select(
        "page_id",
        F.size(text.path_split(F.col("url"))).alias("n_parts"),
        parent.alias("parent"),
        leaf.alias("leaf"),
        comma_parent.alias("comma_parent"),
        comma_leaf.alias("comma_leaf"),
    )


@query
def parse_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = raw_of(spark, sf_dir).selectExpr(
        "id",
        """CASE CAST(id AS BIGINT) % 4
             WHEN 0 THEN concat(operation, ' in attributes.tags')
             WHEN 1 THEN concat(operation, ' not in attributes.sourceName')
             WHEN 2 THEN concat(operation, ' in x not in actor.name')
             ELSE operation END AS text""",
    )
    parsed = text.parse_conditions("text")
    return conditions.select("id", *[column.alias(name) for name, column in parsed.items()])


@query
def iso_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(spark, sf_dir).select(
        "id", temporal.iso_text(temporal.minus_minutes(temporal.instant("created"))).alias("lagged")
    )


@query
def older_than_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(SAFETY_NOW).cast("timestamp")
    then = temporal.instant("created")
    return raw_of(spark, sf_dir).select(
        "id",
        temporal.whole_days_between(now, then).alias("days"),
        temporal.older_than_day(now, then).alias("older"),
    )


@query
def escape_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(spark, sf_dir).select("id", text.escape_literal(F.col("created")).alias("escaped"))


@query
def type_clause(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the mapped types bound the set that is collected
    wanted = filters.of_types(raw_of(spark, sf_dir), fx.demo_mapping().wanted_types)
    return wanted.agg(text.type_clause(F.collect_set("type")).alias("clause"))


# --- streaming and incremental --------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str, name: str, *, load=None, **options) -> tuple[LoadJob, DataFrame]:
    """Stream the events into a fresh lake; job and raw schema."""
    # a pattern, as a stream takes a file or a folder of files only through one
    events = raw_source.stream_events(spark, f"{sf_dir}/events.parque[t]", schema=EVENTS_SCHEMA, **options)
    raw = fx.audit_view(events)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, name), fx.TENANT)
    ingest_stream(raw, job, fresh_folder(spark, f"{name}-offsets"), load=load).awaitTermination()
    return job, raw


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, *_ingested(spark, sf_dir, "stream"))


def load_twice(batch: DataFrame, job: LoadJob, batch_id: int, run: str) -> LoadResult:
    """As after a crash between the write and its commit."""
    load_batch(batch, job, batch_id, run)
    return load_batch(batch, job, batch_id, run)


@query
def stream_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landed(spark, *_ingested(spark, sf_dir, "replay", load=load_twice))
    return found.groupBy("class_name", "eventDay").agg(F.count("*").alias("n_events"))


def event_files(path: str) -> RawFiles:
    """The files of an events table as raw files."""
    shape = lambda events: fx.audit_view(events, FILE_COLUMN)
    return RawFiles(path, schema=EVENTS_SCHEMA, shape=shape)


def _run_in_steps(spark: SparkSession, sf_dir: str, name: str, store_type=PositionStore) -> DataFrame:
    """Runs at two clocks, from the default start; the second takes what the first left."""
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, name), fx.TENANT)
    folder, files = fresh_folder(spark, f"{name}-ledger"), event_files(f"{sf_dir}/events.parquet")
    ingest_files(files, job, FileLedger(spark, folder, store_type(spark, f"{folder}/state")), SAFETY_NOW)
    # what a crash left planned is loaded again before anything new
    ingest_files(files, job, FileLedger(spark, folder), fx.NOW)
    ingest_files(files, job, FileLedger(spark, folder), fx.NOW)
    return landed(spark, job, raw_of(spark, sf_dir))


@query
def batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_in_steps(spark, sf_dir, "batch")


@query
def table_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As batch_ingest, from a table, whose position is a time and not a list of files."""
    raw = raw_of(spark, sf_dir)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "table"), fx.TENANT)
    store = PositionStore(spark, fresh_folder(spark, "table-position"))
    for now in (SAFETY_NOW, fx.NOW):
        run_once(raw, job, store, now)
    return landed(spark, job, raw)


class LosesCommits(PositionStore):
    """A store whose writer dies after each load, before the commit."""

    def write(self, state: Position) -> None:
        if not state.committed:
            super().write(state)


@query
def batch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _run_in_steps(spark, sf_dir, "batch-replay", LosesCommits)
    return found.groupBy("class_name", "eventDay").agg(F.count("*").alias("n_events"))


def _with_side_rows(spark: SparkSession, job: LoadJob, raw: DataFrame) -> DataFrame:
    """Ids of the records by class and day, and of the events put aside by reason."""
    records = landed(spark, job, raw).select("id", "class_name", "eventDay")
    side = spark.read.schema("event string, reason string").parquet(job.rejected_location())
    ids = F.get_json_object("event", "$.id").alias("id")
    return records.unionByName(side.select(ids, F.col("reason").alias("class_name"), F.lit(None).cast("string").alias("eventDay")))


@query
def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in three files, each after a run has passed all their times.

    Every file holds events of the whole month, and every tenth event without a type twice.
    """
    events = events_of(spark, sf_dir)
    folder, late = fresh_folder(spark, "late"), fresh_folder(spark, "late-ledger")
    shape = lambda stored: fx.audit_view(stored, FILE_COLUMN).withColumn(
        "type", F.when(F.col("id").cast("bigint") % 10 != 0, F.col("type"))
    )
    files = RawFiles(folder, schema=EVENTS_SCHEMA, shape=shape)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "late-lake"), fx.TENANT)
    for part, now in enumerate((SAFETY_NOW, SAFETY_NOW, fx.NOW)):
        own = events.filter(F.pmod("event_id", F.lit(3)) == part)
        again = own.filter("event_id % 10 = 0")
        own.unionByName(again).write.mode("append").parquet(folder)
        ingest_files(files, job, FileLedger(spark, late), now)
    return _with_side_rows(spark, job, raw_of(spark, sf_dir))


@query
def bounded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run bound to the oldest 12 000 of events that were each delivered four times, with
    times cut to the hour, so that the bound falls among equal ones."""
    events = events_of(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(3))))
    raw = fx.audit_view(events, "copy").selectExpr("* EXCEPT (copy, id, created)", "concat(id, '-', copy) AS id", "concat(left(created, 14), '00:00.000Z') AS created")
    folder = fresh_folder(spark, "bounded")
    raw.write.parquet(f"{folder}/raw")
    job = LoadJob(fx.demo_mapping(), f"{folder}/lake", fx.TENANT)
    files = RawFiles(f"{folder}/raw", schema=raw.schema)
    ingest_files(files, job, FileLedger(spark, f"{folder}/ledger"), fx.NOW, limit=12_000, bounded=True)
    return landed(spark, job, raw).select("id", "class_name", "eventDay")


@query
def safety_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_between(spark, sf_dir, None, filters.upper_bound(SAFETY_NOW)).select("id", "created")


@query
def clamp_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_of(spark, sf_dir)
    last = events.groupBy("user_id").agg(F.max("ts").alias("ts"))
    saved = F.when(F.col("user_id") % 11 != 0, F.date_format("ts", temporal.ISO_PATTERN))
    return clamp_saved(last.select("user_id", saved.alias("saved")), "saved", CLAMP_NOW)


# --- open bodies ----------------------------------------------------------------

OPEN_BODY = """concat('{"id": ', event_id, ', "kind": "', event_type, '", "click": {"gone": true}, "time": "',
  date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), '", "n": null, "ok": true, "a": {"click": 1, "kind": "', event_type,
  '", "list": ["', event_type, '", "click", {"click": 2, "size": ', user_id, '}, ["click", 1.5]], "at": "',
  date_format(ts, 'yyyy-MM-dd'), '", "deep": {"at": "', event_type, '"}}, "data": {"time": "', date_format(ts, 'yyyy-MM-dd'), '"}, "empty": {}}')"""


@query
def prune_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key and a text removed everywhere from bodies of open shape."""
    bodies = events_of(spark, sf_dir).selectExpr("event_id AS id", f"parse_json({OPEN_BODY}) AS body")
    return bodies.select("id", F.to_json(open_bodies.prune_open("body", "click")).alias("body"))


@query
def epoch_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = events_of(spark, sf_dir).selectExpr("event_id AS id", f"parse_json({OPEN_BODY}) AS body")
    paths = [("time",), ("a", "at"), ("a", "deep", "at"), ("a", "list", "size"), ("data", "time"), ("missing",)]
    done = bodies.select("id", open_bodies.epoch_open("body", paths).alias("body"))
    get = lambda path, kind: F.try_variant_get("body", path, kind)
    return done.select(
        "id",
        get("$.time", "bigint").alias("time"),
        get("$.a.at", "bigint").alias("a_at"),
        get("$.a.deep.at", "string").alias("deep_at"),
        get("$.data.time", "string").alias("data_time"),
        F.to_json(get("$.a.list", "variant")).alias("list"),
        F.schema_of_variant(get("$.time", "variant")).alias("time_kind"),
    )


# bodies whose size is a number or text, whose note may be missing, with lists of lists and
# keys that are ids
PATHS_BODY = """concat('{"type": "', event_type, '", "size": ', CASE WHEN event_id % 3 = 0 THEN '"large"' ELSE CAST(event_id AS STRING) END,
  CASE WHEN event_id % 4 = 0 THEN ', "note": null' WHEN event_id % 4 = 1 THEN ', "note": "n"' ELSE '' END,
  ', "tags": ["a", ["b", ', user_id, ']], "by_user": {"', user_id, '": {"seen": true}}, "a.b": {}}')"""


@query
def schema_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths and kinds of open bodies, of two halves of the events and then merged."""
    events = events_of(spark, sf_dir)
    bodies = events.selectExpr("event_id", "event_type AS class_name", f"parse_json({PATHS_BODY}) AS body")
    halves = [discovery.discover_paths(bodies.filter(half)) for half in ("event_id % 2 = 0", "event_id % 2 = 1")]
    return discovery.with_shares(discovery.merge_paths(*halves))


@query
def landed_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions over open bodies that were landed as Parquet."""
    folder = fresh_folder(spark, "landed")
    text = fx.audit_view(events_of(spark, sf_dir)).select(F.to_json(F.struct("*")).alias("text"))
    raw_source.land_open_events(text.select(F.parse_json("text").alias("body")), folder)
    bodies = raw_source.scan_landed_open(spark, folder)
    found = bodies.filter(condition_column("user_1 in actor.name", bodies, "body") | condition_column("E in operation", bodies, "body"))
    opened = nested.VariantBody("body")
    return found.select(
        nested.nested_get(opened, ["id"]).alias("id"),
        condition_column("t1 in attributes.tags", found, "body").alias("has_t1"),
        nested.nested_get(opened, ["actor", "name"]).alias("actor_name"),
    )


@query
def bucketed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions from a stored lookup, joined bucket by bucket as one too large to broadcast."""
    database = f"auditlake_buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{fresh_folder(spark, 'buckets')}'")
    keys = ("type", "operation")
    raw = raw_of(spark, sf_dir).select("id", *keys)
    stored = store_bucketed(raw, f"{database}.events", keys, 8)
    terms = terms_frame(spark, TERMS).withColumnRenamed("term", "operation")
    lookup = store_bucketed(terms, f"{database}.terms", keys, 8).withColumnRenamed("operation", "term")
    found = lookups.normalize_term(stored, lookup.hint("merge"), "operation", MAX_BROADCAST_ROWS + 1, hit="hit")
    return found.select("id", "type", "operation", "caption", "hit")


# --- catalog, hooks, history ----------------------------------------------------


@query
def catalog_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class tables by name, after two loads that kept them up to date."""
    raw = raw_of(spark, sf_dir)
    database = f"auditlake_lake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{fresh_folder(spark, 'lake-catalog')}'")
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "named-lake"), fx.TENANT, database=database)
    for batch_id, half in enumerate(("created < '2024-01-20'", "created >= '2024-01-20'")):
        load_batch(raw.filter(half), job, batch_id)
    parts = []
    for class_name in job.mapping.classes():
        if spark.catalog.tableExists(f"{database}.{class_name}"):
            named = raw_source.scan_table(spark, database, class_name).withColumn("class_name", F.lit(class_name))
            parts.append(flat(named, *lake.PARTITION_KEYS))
    return paging.append_pages(*parts)


@query
def hooked_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transforms of the mapping document that are SQL functions of the session."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION auditlake_masked(name STRING) RETURNS STRING RETURN concat(left(name, 5), repeat('*', length(name) - 5))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION auditlake_weight(word STRING) RETURNS INT RETURN length(word) * 10")
    rules = {
        "actor,name": [{"target_field": "who", "transform": "masked"}],
        "operation": [{"target_field": "load", "transform": "weight"}, {"target_field": "label", "transform": "normalize"}],
    }
    mapping = mapping_of(rules)
    hooks = sql_functions(spark, {"masked": "auditlake_masked", "weight": "auditlake_weight"}, mapping)
    raw = raw_of(spark, sf_dir)
    job = LoadJob(mapping, fresh_folder(spark, "hooked"), fx.TENANT, hooks=hooks)
    load_batch(raw, job, 0)
    record = job.compiled(raw).transform(raw).schema
    found = lake.read_lake(spark, job.shared_location(), record, ("class_name", *lake.PARTITION_KEYS))
    return found.select("data.id", "class_name", "who", "load", "label")


@query
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that hit or miss, added up from what three runs kept of themselves."""
    folder = fresh_folder(spark, "history")
    job = LoadJob(fx.demo_mapping(), f"{folder}/lake", fx.TENANT)
    history, files = RunHistory(spark, f"{folder}/history"), event_files(f"{sf_dir}/events.parquet")
    for now in (fx.CHECKPOINT, SAFETY_NOW, fx.NOW):
        ingest_files(files, job, FileLedger(spark, f"{folder}/ledger"), now, history=history)
    n_runs, n_written = history.runs().agg(F.count("*"), F.sum("transformed")).first()
    return history.coverage().withColumns({"n_runs": F.lit(n_runs).cast("bigint"), "n_written": F.lit(n_written).cast("bigint")})


@query
def compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake of three batches whose closed days are merged, and an old batch that comes again."""
    raw = raw_of(spark, sf_dir)
    job = LoadJob(fx.demo_mapping(), fresh_folder(spark, "compacted"), fx.TENANT)
    for batch_id in range(3):
        load_batch(raw.filter(F.pmod(F.col("id").cast("bigint"), F.lit(3)) == batch_id), job, batch_id)
    compact_days(spark, job, before="20240125")
    load_batch(raw.filter(F.pmod(F.col("id").cast("bigint"), F.lit(3)) == 1), job, 1)
    leaves = lake.read_lake(spark, job.shared_location(), T.StructType(), ("class_name", "eventDay"), with_path=True)
    batches = F.count_distinct(F.regexp_extract("path", "batch=([^/]+)", 1)).alias("n_leaves")
    return leaves.groupBy("class_name", "eventDay").agg(F.count("*").alias("n_events"), batches)


@query
def replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that a stream delivers again, in the next delivery, some without an id.

    Four deliveries, of as many files as tasks wrote them, are four micro-batches; the stream
    is stopped after two and started again.
    """
    events = events_of(spark, sf_dir)
    folder = fresh_folder(spark, "delivered")
    shape = lambda stored: fx.audit_view(stored).withColumn("id", F.when(F.col("id").cast("bigint") % 50 != 0, F.col("id")))
    job = LoadJob(fx.demo_mapping(), f"{folder}/lake", fx.TENANT)
    for part in range(4):
        own = F.pmod("event_id", F.lit(4)) == part
        again = (F.pmod("event_id", F.lit(4)) == part - 1) & (F.col("user_id") % 3 == 0)
        events.filter(own | again).write.mode("append").parquet(f"{folder}/raw")
        if part % 2:
            n_files = len(spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/raw").inputFiles())
            stored = raw_source.stream_events(spark, f"{folder}/raw", schema=EVENTS_SCHEMA, max_files=max(1, -(-n_files // (part + 1))))
            ingest_stream(without_replays(shape(stored)), job, f"{folder}/offsets").awaitTermination()
    return landed(spark, job, shape(events)).select("id", "class_name", "created")
