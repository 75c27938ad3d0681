"""Open bodies, refused documents and the shared folder."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from auditlake import fixtures as fx
from auditlake.functions.nested import prune_frame
from auditlake.plans.conditions import condition_column
from auditlake.plans.mapping import MappingError, load_mapping, prune
from auditlake.sources import workspace
from auditlake.sources.terms import ENUMS, TERMS


def test_membership_in_lists_of_open_values(spark):
    rows = spark.createDataFrame([('["t1", 2]',), ('[["t1"], 1]',), ("[]",), (None,)], "json string")
    open_lists = rows.select(F.expr("CAST(try_parse_json(json) AS ARRAY<VARIANT>)").alias("tags"))
    for text, expected in (("t1 in tags", [True, False, False, False]), ("Sys in tags", [False, False, True, True]), ("t1 not in tags", [False, True, True, True])):
        assert [r[0] for r in open_lists.select(condition_column(text, open_lists)).collect()] == expected


def test_no_text_is_a_key_of_other_keys(spark):
    maps = spark.sql("SELECT map(1, 'a') AS m UNION ALL SELECT CAST(map() AS MAP<INT, STRING>)")
    assert sorted(r[0] for r in maps.select(condition_column("1 in m", maps)).collect()) == [False, False]


def test_entries_of_a_variant_are_not_dropped_silently(spark):
    with pytest.raises(TypeError, match="VARIANT"):
        prune_frame(spark.sql("SELECT parse_json('{\"a\": 1}') AS body"), "a")


def test_null_output_type_is_refused():
    document = json.loads(json.dumps(fx.UNLIKE_MAPPING))
    document["SYSTEM_CONFIG"]["fieldMappings"]["operation"][0]["output_type"] = None
    with pytest.raises(MappingError, match="output_type"):
        load_mapping(document, TERMS, ENUMS)


def test_prune_walks_deep_documents():
    deep = "x"
    for _ in range(5_000):
        deep = {"k": [deep], "x": 1}
    found = prune(deep, "x")
    for _ in range(4_999):
        found = found["k"][0]
    assert found == {"k": []}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session())
    monkeypatch.setattr(Context, "master", "local[2]")
    monkeypatch.setattr(workspace, "_FALLBACK", {})
    assert workspace.shared_folder(Session()) == workspace.shared_folder(Session())
