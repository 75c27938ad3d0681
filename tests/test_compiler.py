"""Compiled records against hand-written ones and against the Python model."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import model
from auditlake import fixtures as fx
from auditlake.plans import compiler
from auditlake.plans.compiler import compile_mapping
from auditlake.plans.mapping import MappingError, load_mapping
from auditlake.sources import local
from auditlake.sources.raw import RAW_EVENT
from auditlake.sources.terms import ENUMS, TERMS


def raw_events(spark, *events):
    return spark.createDataFrame([json.dumps(e) for e in events], "string").select(
        F.from_json("value", RAW_EVENT).alias("e")
    ).select("e.*")


def event(**fields):
    return {
        "id": "1",
        "type": "AUTH",
        "created": "2024-01-05T10:00:00.123Z",
        "operation": "LOGOUT",
        "status": "PASSED",
        "actor": {"name": "ann"},
        "attributes": {"sourceName": "Source 1", "tags": ["t1"]},
        **fields,
    }


def json_of(frame):
    return [json.loads(r[0]) for r in frame.select(F.to_json(F.struct("*"))).collect()]


def test_golden_records(spark):
    raw = raw_events(
        spark,
        event(),
        event(type="SYSTEM_CONFIG", operation="DISABLE", status="FAILED", actor={"name": None}),
        event(type="UNMAPPED"),
        event(type="USER_MANAGEMENT", operation="delete", created="12:30", actor={"name": "user_12"}),
    )
    records = json_of(compile_mapping(fx.demo_mapping(), raw, time_paths=("time",)).transform(raw))
    by_type = {r["data"]["type"]: r for r in records}
    assert by_type.keys() == {"AUTH", "SYSTEM_CONFIG", "USER_MANAGEMENT"}
    auth = by_type["AUTH"]
    assert auth.pop("data") == event()
    assert auth == {
        "class_name": "authentication",
        "metadata": {"version": "1.0.0-rc.2", "product": {"name": "Identity Audit"}},
        "activity_name": "Logoff",
        "activity_id": 2,
        "status": "Success",
        "status_id": 1,
        "time": 1704448800,
        "actor": {"user": {"name": "ann", "type": "User", "type_id": 1}},
        "src": {"name": "Source 1", "group": {"name": "Source 1"}, "kind": "LOGOUT"},
    }
    job = by_type["SYSTEM_CONFIG"]
    assert (job["activity_name"], job["activity_id"]) == ("Enable", 4)
    assert (job["status"], job["status_id"]) == ("Failure", 2)
    # a missing actor reads as System, and nothing of the actor but the name is written
    assert job["actor"] == {"user": {"name": "Source 1"}}
    account = by_type["USER_MANAGEMENT"]
    # terms are case-sensitive, and a matched branch with no value does not fall through
    assert account["activity_name"] == "Other"
    assert account["actor"]["user"]["name"] == "user_12"
    assert "time" not in account


def test_hostile_text_stays_text(spark):
    nasty = "it's \\ a `tick` ${spark.app.name} \" \n -- ; DROP"
    mapping = load_mapping(
        {
            "AUTH": {
                "staticValues": {"class_name": "authentication", "we ird.k'ey": nasty},
                "fieldMappings": {
                    "operation": [
                        {
                            "target_field": "picked",
                            "conditions": [{"condition": f"{nasty} in status", "source_field": "id"}],
                        }
                    ]
                },
            }
        },
        TERMS,
        ENUMS,
    )
    raw = raw_events(spark, event(status=f"..{nasty}.."))
    row = compile_mapping(mapping, raw).transform(raw).first()
    assert row["we ird"]["k'ey"] == nasty
    assert row["picked"] == "1"


def fingerprint(records):
    row = F.xxhash64(F.to_json(F.struct(*records.columns))).cast("decimal(38,0)")
    return records.groupBy("class_name").agg(F.count("*"), F.sum(row)).collect()


def test_one_class_and_all_classes_agree(spark, sf_dir):
    raw = fx.audit_view(spark.read.parquet(f"{sf_dir}/events.parquet"))
    together = compile_mapping(fx.demo_mapping(), raw, time_paths=("time",)).transform(raw)
    alone = [
        fingerprint(compile_mapping(fx.demo_mapping(), raw, c, time_paths=("time",)).transform(raw).select(together.columns))
        for c in fx.demo_mapping().classes()
    ]
    assert sorted(sum(alone, [])) == sorted(fingerprint(together))


def test_lookup_too_large_to_broadcast(spark, sf_dir, monkeypatch):
    raw = fx.audit_view(spark.read.parquet(f"{sf_dir}/events.parquet"))
    expected = fingerprint(compile_mapping(fx.demo_mapping(), raw, time_paths=("time",)).transform(raw))
    monkeypatch.setattr(local, "MAX_BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = compile_mapping(fx.demo_mapping(), raw, time_paths=("time",)).transform(raw)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(fingerprint(joined)) == sorted(expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_static_kinds_and_mixed_types(spark):
    mapping = load_mapping(
        {
            "AUTH": {
                "staticValues": {"class_name": "authentication", "n": 2**40, "f": 1.5, "l": ["a", "b"], "m": [1, "x"], "z": None},
                "fieldMappings": {"operation": [{"target_field": "n"}], "missing": [{"target_field": "z"}]},
            }
        },
        TERMS,
        ENUMS,
    )
    raw = raw_events(spark, event(operation=None))
    out = compile_mapping(mapping, raw).transform(raw)
    assert json_of(out.drop("data")) == [
        {"class_name": "authentication", "n": str(2**40), "f": 1.5, "l": ["a", "b"], "m": [1, "x"]}
    ]
    assert out.schema["n"].dataType == T.StringType()


def test_normalizing_a_struct_is_refused(spark):
    mapping = load_mapping(
        {
            "AUTH": {
                "staticValues": {"class_name": "authentication"},
                "fieldMappings": {"attributes": [{"target_field": "x", "transform": "normalize"}]},
            }
        },
        TERMS,
        ENUMS,
    )
    with pytest.raises(MappingError, match="cannot be normalized"):
        compile_mapping(mapping, raw_events(spark, event()))


def test_hook_transforms_values(spark):
    mapping = load_mapping(
        {
            "AUTH": {
                "staticValues": {"class_name": "authentication"},
                "fieldMappings": {
                    "operation": [{"target_field": "low", "transform": "lower"}, {"target_field": "same", "transform": "other"}]
                },
            }
        },
        TERMS,
        ENUMS,
    )
    raw = raw_events(spark, event())
    hooks = {"lower": lambda sql, rule, target: (f"lower({sql})", T.StringType())}
    row = compile_mapping(mapping, raw, hooks=hooks).transform(raw).first()
    assert (row.low, row.same) == ("logout", "LOGOUT")


# --- open bodies ----------------------------------------------------------------

OPEN_MAPPING = {
    event_type: {
        "staticValues": {"class_name": class_name, "label": "static", "kept": "static"},
        "fieldMappings": {
            "a": [
                {"target_field": "term.name", "transform": "normalize"},
                {"target_field": "term.id", "transform": "normalize", "output_type": "integer", "concat_string": prefix},
                {"target_field": "label"},
            ],
            "b,c": [{"target_field": "copy"}, {"target_field": {"USER": "fan.out", "x": ""}, "transform": "normalize"}],
            "b.c": [{"target_field": "literal"}],
            "any": [
                {
                    "target_field": "picked",
                    "conditions": [
                        {"condition": "LOG in a", "source_field": "b.c"},
                        {"condition": "Sys in b", "source_field": "a"},
                        {"condition": "c not in b.c", "source_field": "b"},
                    ],
                },
                {"target_field": "label", "conditions": [{"condition": "c in b", "source_field": "b.c"}]},
                {"target_field": "kept", "conditions": []},
            ],
        },
    }
    for event_type, class_name, prefix in (("AUTH", "authentication", ""), ("SYSTEM_CONFIG", "scheduled_job_activity", "p "))
}
OPEN_ENUMS = {"('term', 'id')": {"Logoff": 7, "Other": 9, "p Start": 3}}


def random_value(rng, depth=0):
    scalars = ["", "LOGOUT", "LOG", "REQUEST", "System", "c", "it's ${x}", 0, 5, 1.5, True, False, None]
    kind = rng.random()
    if depth < 2 and kind < 0.2:
        return [random_value(rng, depth + 1) for _ in range(rng.randint(0, 2))]
    if depth < 2 and kind < 0.5:
        return {k: random_value(rng, depth + 1) for k in rng.sample(["c", "d", "LOG"], rng.randint(0, 2))}
    return rng.choice(scalars)


def open_events():
    rng = random.Random(7)
    made = []
    for number in range(1500):
        body = {"type": rng.choice(["AUTH", "SYSTEM_CONFIG", "NOPE"]), "n": number}
        for key in ("a", "b", "b.c"):
            if rng.random() < 0.8:
                body[key] = random_value(rng)
        made.append(body)
    return made


def test_open_bodies_agree_with_the_model(spark):
    mapping = load_mapping(OPEN_MAPPING, TERMS, OPEN_ENUMS)
    events = open_events()
    raw = spark.createDataFrame([(json.dumps(e),) for e in events], "text string").select(
        F.parse_json("text").alias("body")
    )
    compiled = compile_mapping(mapping, raw, variant_column="body")
    expected, unmappable = {}, set()
    for body in events:
        try:
            found = model.record(mapping, body)
        except model.Unmappable:
            unmappable.add(body["n"])
            continue
        if found is not None:
            found = {k: v if k == "term.id" else model.as_text(v) for k, v in found.items()}
            expected[body["n"]] = {k: v for k, v in found.items() if v is not None}
    got = {}
    paths = ["class_name", "label", "kept", "term.name", "term.id", "copy", "fan.out", "literal", "picked"]
    rows = compiled.transform(raw, on_bad="side").select(
        F.expr("variant_get(data, '$.n', 'int')").alias("n"), *[F.col(p).alias(p) for p in paths]
    )
    for row in rows.collect():
        values = row.asDict()
        number = values.pop("n")
        got[number] = {k: v for k, v in values.items() if v is not None}
    assert got == expected
    side = compiled.unmappable(raw).collect()
    assert {json.loads(r.event)["body"]["n"] for r in side} == unmappable
    assert unmappable
    with pytest.raises(PySparkException, match="cannot be normalized"):
        compiled.transform(raw).collect()
    # conditions over numbers and true take no branch, and are counted
    undecided = raw.select(compiled.undecided().alias("n")).agg(F.sum("n")).first()[0]
    by_model = sum(
        sum(model.holds(b.condition, e) is None for r in mapping.types[e["type"]].rules for b in r.branches or ())
        for e in events
        if e["type"] in mapping.types
    )
    assert undecided == by_model > 0


def test_declared_types_of_open_bodies(spark):
    mapping = load_mapping(OPEN_MAPPING, TERMS, OPEN_ENUMS)
    raw = spark.createDataFrame([('{"type": "AUTH", "b": {"c": 12}, "b.c": [1, 2]}',)], "text string").select(
        F.parse_json("text").alias("body")
    )
    compiled = compile_mapping(
        mapping, raw, variant_column="body", target_types={"copy": "bigint", "literal": "array<int>"}
    )
    row = compiled.transform(raw).first()
    assert (row.copy, row.literal) == (12, [1, 2])


def test_reserved_names_are_refused(spark):
    frame = spark.createDataFrame([("AUTH", "x")], f"type string, {compiler._PREFIX}x string")
    with pytest.raises(MappingError, match="reserved"):
        compile_mapping(fx.demo_mapping(), frame)
