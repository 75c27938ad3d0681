"""Conditions, times, text and nested functions on edge cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions import nested, temporal, text
from auditlake.functions.sqltext import ident, literal, variant_path
from auditlake.plans.conditions import condition_column
from auditlake.plans.mapping import MappingError


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column).first()[0]


@pytest.mark.parametrize(
    ("spelled", "epoch", "wall"),
    [
        ("2023-01-01T10:00:00Z", 1672567200, 1672567200),
        ("2023-01-01T10:00:00.123Z", 1672567200, 1672567200),
        ("2023-01-01T10:00:00.123456Z", 1672567200, 1672567200),
        ("2023-01-01T10:00:00.123456789Z", 1672567200, 1672567200),
        ("2023-01-01T10:00:00+02:00", 1672560000, 1672567200),
        ("2023-01-01 10:00", 1672567200, 1672567200),
        ("2023-01-01", 1672531200, 1672531200),
        ("1969-12-31T23:59:59.5Z", -1, -1),
        ("2023-13-01T10:00:00Z", None, None),
        ("10", None, None),
        ("May", None, None),
        ("12:30", None, None),
        ("2023", None, None),
        ("Logon", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_epoch(spark, spelled, epoch, wall):
    assert one(spark, spelled, temporal.to_epoch("x")) == epoch
    assert one(spark, spelled, temporal.to_epoch("x", ignore_offset=True)) == wall


@pytest.mark.parametrize(
    ("spelled", "day"),
    [("2024-02-29T23:59:59.999Z", "20240229"), ("2024-03-01T00:30:00+02:00", "20240229"), ("soon", None), (None, None)],
)
def test_event_day(spark, spelled, day):
    assert one(spark, spelled, temporal.event_day("x")) == day


@pytest.mark.parametrize(
    ("then", "days", "older"),
    [
        ("2024-01-01T00:00:01Z", 0, False),
        ("2024-01-01T00:00:00Z", 1, True),
        ("2024-01-01T00:00:00.001Z", 0, False),
        ("2024-01-02T01:00:00Z", -1, False),
    ],
)
def test_older_than_day(spark, then, days, older):
    now = F.lit("2024-01-02T00:00:00Z").cast("timestamp")
    assert one(spark, then, temporal.whole_days_between(now, temporal.instant("x"))) == days
    assert one(spark, then, temporal.older_than_day(now, temporal.instant("x"))) is older


@pytest.mark.parametrize(
    ("saved", "expected"),
    [
        (None, "2024-01-30T23:00:00.000Z"),
        ("2024-01-29T23:00:00.000Z", "2024-01-30T23:00:00.000Z"),
        ("2024-01-29T23:00:00.001Z", "2024-01-29T23:00:00.001Z"),
        ("2024-02-02T00:00:00.000Z", "2024-02-02T00:00:00.000Z"),
    ],
)
def test_clamp(spark, saved, expected):
    now = F.lit("2024-01-31T00:00:00Z").cast("timestamp")
    column = temporal.iso_text(temporal.clamp_position(temporal.instant("x"), now))
    assert one(spark, saved, column) == expected


def test_text_functions(spark):
    assert one(spark, "\t a b \n", text.trim_all(F.col("x"))) == "a b"
    assert one(spark, " \t\n", text.is_blank(F.col("x"))) is True
    assert one(spark, "2024-01-02T03:04:05.6Z", text.escape_literal(F.col("x"))) == r"2024\-01\-02T03\:04\:05\.6Z"
    assert one(spark, "a.b.c", F.struct(*text.path_tail(F.col("x")))) == ("b", "c")
    assert one(spark, "a", F.struct(*text.path_tail(F.col("x")))) == (None, "a")
    assert one(spark, "B,A", text.type_clause(F.split("x", ","))) == "type:A OR type:B"
    assert one(spark, "o", text.enum_key(F.col("x"), F.lit("a"))) == "('o', 'a')"


@pytest.mark.parametrize(
    ("url", "secure"),
    [("http://x", False), ("HTTPS://x", True), ("https://x y", True), ("ftp:https://x", False), ("x", False), ("", False), (None, False)],
)
def test_https(spark, url, secure):
    assert one(spark, url, text.is_https(F.col("x"))) is secure


def test_parse_conditions_in_bulk(spark):
    pieces = text.parse_conditions("x")
    column = F.struct(*[pieces[n].alias(n) for n in ("value", "negated", "path")])
    assert one(spark, "a in b not in c.d", column) == ("a in b", True, "c.d")
    assert one(spark, "a b in c in d", column) == ("a b", False, "c in d")
    assert one(spark, "nothing", column) == (None, None, None)


def test_literals_survive_the_parser(spark):
    for value in ["it's", "back\\slash", "${spark.app.name}", "nul\ttab\nline", "\\u0041", "%_", "", "ü€𝄞"]:
        assert spark.sql(f"SELECT {literal(value)}").first()[0] == value
    assert spark.sql(f"SELECT 1 AS {ident('a`b.c')}").columns == ["a`b.c"]
    assert spark.sql(f"SELECT {literal(2**40)}, {literal(True)}, {literal(1.5)}, {literal(None)}").first() == (
        2**40,
        True,
        1.5,
        None,
    )
    key = "a'.b"
    body = json.dumps({key: 5})
    assert spark.sql(f"SELECT try_variant_get(parse_json({literal(body)}), {variant_path([key])}, 'int')").first()[0] == 5
    with pytest.raises(ValueError, match="substitution"):
        ident("${x}")
    with pytest.raises(ValueError, match="quote"):
        variant_path(["a'b\"c"])


SCHEMA = (
    "s string, n int, d double, b boolean, l array<string>, ln array<int>, m map<string,int>, "
    "o struct<k: string, j: string>, t timestamp"
)


@pytest.mark.parametrize(
    ("condition", "row", "expected"),
    [
        ("ys in s", {"s": None}, True),
        ("Sys in s", {"s": ""}, True),
        ("sys in s", {"s": ""}, False),
        ("Sys in missing.deeper", {}, True),
        ("Sys in s.deeper", {"s": "text"}, True),
        ("a in s", {"s": "cab"}, True),
        ("A in s", {"s": "cab"}, False),
        ("a not in s", {"s": "cab"}, False),
        ("Sys in n", {"n": 0}, True),
        ("Sys in n", {"n": 5}, None),
        ("Sys not in n", {"n": 5}, None),
        ("Sys not in n", {"n": None}, False),
        ("Sys in d", {"d": 0.0}, True),
        ("Sys in b", {"b": False}, True),
        ("Sys in b", {"b": True}, None),
        ("x in l", {"l": ["xy", "x"]}, True),
        ("x in l", {"l": ["xy"]}, False),
        ("x in l", {"l": ["xy", None]}, False),
        ("x not in l", {"l": ["xy", None]}, True),
        ("System in l", {"l": []}, True),
        ("1 in ln", {"ln": [1]}, False),
        ("k in m", {"m": {"k": None}}, True),
        ("j in m", {"m": {"k": 1}}, False),
        ("System in m", {"m": {}}, True),
        ("k in o", {"o": {"k": "v", "j": None}}, True),
        ("j in o", {"o": {"k": "v", "j": None}}, False),
        ("System in o", {"o": {"k": None, "j": None}}, True),
        ("q in o", {"o": {"k": "v", "j": None}}, False),
    ],
)
def test_conditions(spark, condition, row, expected):
    schema = T.StructType.fromDDL(SCHEMA)
    frame = spark.createDataFrame([tuple(row.get(n) for n in schema.fieldNames())], schema)
    assert frame.select(condition_column(condition, frame)).first()[0] is expected


def test_condition_without_operator(spark):
    with pytest.raises(MappingError):
        condition_column("a of b", spark.range(1))


def test_nested_set_and_get(spark):
    frame = spark.createDataFrame([("v", None)], "a string, b string")
    out = nested.nested_set(frame, {"x.y.z": "a", "x.w": "b", "gone.deep": "b"})
    assert json.loads(out.select(F.to_json(F.struct("*"))).first()[0]) == {"x": {"y": {"z": "v"}}}
    with pytest.raises(ValueError):
        nested.nested_set(frame, {"x": "a", "x.y": "b"})
    with pytest.raises(ValueError):
        nested.nested_set(frame, {"x.y": "a", "x": "b"})
    body = nested.StructBody(out.schema)
    assert out.select(nested.nested_get(body, ["x", "y", "z"])).first()[0] == "v"
    assert out.select(nested.nested_get(body, ["x", "Y", "z"], "string")).first()[0] is None


def test_prune_key_keeps_nulls(spark):
    frame = spark.createDataFrame(
        [({"k": "v", "drop": "x", "y": "drop", "n": None}, ["drop", None, "a"], ("drop", "b"), [("drop", 1)])],
        "m map<string,string>, l array<string>, o struct<p: string, q: string>, s array<struct<p: string, drop: int>>",
    )
    row = nested.prune_frame(frame, "drop").first()
    assert row.m == {"k": "v", "n": None}
    assert row.l == [None, "a"]
    assert row.o == (None, "b")
    assert row.s[0].asDict() == {"p": None}


def test_epoch_walk_leaves_data_and_lists(spark):
    stamp = "2023-01-01T10:00:00Z"
    frame = spark.createDataFrame(
        [(stamp, (stamp, "May"), (stamp,), [(stamp,)], None)],
        "t string, o struct<t: string, u: string>, data struct<t: string>, l array<struct<t: string>>, e struct<t: string>",
    )
    paths = [("t",), ("o", "t"), ("o", "u"), ("data", "t"), ("l", "t"), ("e", "t")]
    row = temporal.epoch_all_fields(frame, paths).first()
    assert row.t == row.o.t == 1672567200
    assert row.o.u is None
    assert row.data.t == row.l[0].t == stamp
    assert row.e is None
