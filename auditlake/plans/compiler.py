"""Compile a mapping document to native Spark operators.

What a rule writes is a constant that depends on the event type, a constant that
depends on type and term, or a copy of a raw value. The constants are worked out
on the driver and become two kinds of small broadcast table: one row per event
type, and per normalized source one row per (type, term) that has an entry. An
event takes them in hash lookups, whose cost does not grow with the number of
types, terms or targets, and the generated code stays small. There is no shuffle
and no Python UDF.

The other expressions are emitted as SQL text: conditional sources first, then leaf
values, then the nested record.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.nested import Body, Leaf, assemble, body_of, is_json_type
from auditlake.functions.sqltext import ident, in_list, literal
from auditlake.functions.temporal import epoch_sql
from auditlake.plans.conditions import condition_sql, may_be_undecided
from auditlake.plans.mapping import (
    INT_MAX,
    INT_MIN,
    MISSING_CAPTION,
    EventMapping,
    MappingError,
    Rule,
    Target,
    TypeRules,
)
from auditlake.sources.local import local_frame, small
from auditlake.sources.raw import require_utc

# Transform hook: SQL text of the source value, rule, target -> SQL text, type.
Hook = Callable[[str, Rule, Target], tuple[str, T.DataType]]

_PREFIX = "__al_"
_BAD = f"{_PREFIX}bad"
_TYPE = f"{_PREFIX}type"


@dataclass(frozen=True)
class Typed:
    sql: str
    dtype: T.DataType
    nullable: bool = True


@dataclass
class Lookup:
    """Constants joined to the events: key columns first, then one per slot.

    ``term_sql`` is the source the terms belong to; without it the key is the type.
    """

    schema: T.StructType
    rows: list[tuple]
    term_sql: str | None = None

    def join(self, df: DataFrame, type_column: str) -> DataFrame:
        table = small(local_frame(df.sparkSession, self.rows, self.schema), len(self.rows))
        names = self.schema.fieldNames()
        if self.term_sql is None:
            return df.join(table, df[type_column] == table[names[0]], "inner").drop(names[0])
        matches = (df[type_column] == table[names[0]]) & (F.expr(self.term_sql) == table[names[1]])
        return df.join(table, matches, "left").drop(*names[:2])


@dataclass
class CompiledMapping:
    """The steps that turn raw events of some types into records."""

    types: list[str]
    type_sql: str
    sources: list[str]
    lookups: list[Lookup]
    values: list[str]
    record: list[str]
    bad: str | None
    undecided_sql: list[str] = field(default_factory=list)

    def keep(self, df: DataFrame) -> DataFrame:
        """Events with a mapping; the type test reaches the Parquet scan."""
        return df.filter(f"{self.type_sql} IN {in_list(self.types)}")

    def transform(self, df: DataFrame, on_bad: str = "fail", seen: Observation | None = None) -> DataFrame:
        """Map raw events. ``on_bad="side"`` leaves bad ones to :meth:`unmappable`, and counts
        them as ``bad`` of ``seen``."""
        valued = self._valued(self.keep(df))
        if seen is not None:
            valued = valued.observe(seen, F.count_if(F.expr(f"{_BAD} IS NOT NULL") if self.bad else F.lit(False)).alias("bad"))
        if self.bad and on_bad == "fail":
            valued = valued.filter(
                f"CASE WHEN {_BAD} IS NULL THEN TRUE ELSE CAST(raise_error({_BAD}) AS BOOLEAN) END"
            )
        elif self.bad:
            valued = valued.filter(f"{_BAD} IS NULL")
        return valued.selectExpr(*self.record)

    def _valued(self, df: DataFrame) -> DataFrame:
        joined = df.selectExpr("*", *self.sources)
        for lookup in self.lookups:
            joined = lookup.join(joined, _TYPE)
        bad = [f"{self.bad} AS {_BAD}"] if self.bad else []
        return joined.selectExpr(*self.values, *bad)

    def untyped(self, df: DataFrame) -> DataFrame:
        """Events without a type, as ``(event, reason)``."""
        return df.filter(f"{self.type_sql} IS NULL").select(
            F.to_json(F.struct("*")).alias("event"), F.lit("event has no type").alias("reason")
        )

    def unmappable(self, df: DataFrame) -> DataFrame | None:
        """Events holding a value no rule can map; None where the types rule it out."""
        if self.bad is None:
            return None
        sourced = self.keep(df).select(F.struct("*").alias("event"), "*").selectExpr("*", *self.sources)
        return sourced.select(F.to_json("event").alias("event"), F.expr(self.bad).alias("reason")).filter(
            "reason IS NOT NULL"
        )

    def undecided(self) -> Column:
        """Number of conditions of an event whose test is not defined."""
        if not self.undecided_sql:
            return F.lit(0)
        return F.expr(" + ".join(f"CASE WHEN {s} THEN 1 ELSE 0 END" for s in self.undecided_sql))


def compile_mapping(
    mapping: EventMapping,
    df: DataFrame,
    class_name: str | None = None,
    *,
    variant_column: str | None = None,
    time_paths: Collection[str] = (),
    target_types: Mapping[str, str] | None = None,
    hooks: Mapping[str, Hook] | None = None,
    ignore_offset: bool = False,
    targets: Collection[str] | None = None,
) -> CompiledMapping:
    """Compile the rules of one class, or of all classes into one shared record.

    ``df`` gives the raw schema; no data is read. ``time_paths`` are the dotted
    targets that hold a time and become epoch seconds. ``target_types`` declares
    types where the source cannot tell, as with a VARIANT body.

    With ``targets`` the record has ``class_name`` and what lies at or below these dotted
    paths, ``data`` for the raw event included. Only the lookups they need are joined,
    and bad values elsewhere do not fail the run; Spark cannot drop a join by itself, as
    it does not know that its keys are unique.
    """
    require_utc(df.sparkSession)
    body = body_of(df, variant_column)
    if not variant_column:
        clash = [n for n in df.columns if n.startswith(_PREFIX)]
        if clash or "type" not in df.columns:
            raise MappingError(f"raw events need a type column and no reserved names, got {df.columns}")
    types = mapping.types_of(class_name) if class_name else list(mapping.types)
    if not types:
        raise MappingError(f"no event type maps to class {class_name!r}")
    declared = {tuple(k.split(".")): T.DataType.fromDDL(v) for k, v in (target_types or {}).items()}
    builder = _Builder(mapping, body, dict(hooks or {}), declared)
    per_type = {t: builder.leaves(mapping.types[t]) for t in types}
    times = {tuple(p.split(".")) for p in time_paths}

    leaves: dict[tuple[str, ...], Leaf] = {}
    whole = targets is None or "data" in targets
    values = [f"{body.whole_sql()} AS {ident('data')}"] if whole else []
    type_sql = ident(_TYPE)
    paths = [("class_name",)]
    paths += [p for p in _in_order(per_type) if p != ("class_name",) and _is_wanted(p, targets)]
    for number, path in enumerate(paths):
        found = {t: per_type[t][path] for t in types if path in per_type[t]}
        dtype = declared.get(path) or _common_type([v.dtype for v in found.values()])
        branches = {t: _cast(v, dtype) for t, v in found.items()}
        sql = _dispatch(type_sql, branches, types)
        if path in times:
            sql = _as_epoch(sql, dtype, ignore_offset)
        name = f"{_PREFIX}v{number}"
        values.append(f"{sql} AS {ident(name)}")
        certain = path not in times and len(found) == len(types) and not any(v.nullable for v in found.values())
        leaves[path] = Leaf(ident(name), nullable=not certain)

    try:
        record = [f"{leaf.sql} AS {ident(name)}" for name, leaf in assemble(leaves)]
    except ValueError as problem:
        raise MappingError(str(problem)) from None
    return CompiledMapping(
        types=types,
        type_sql=body.type_sql(),
        sources=builder.source_columns(types),
        lookups=builder.lookups(types, values),
        values=values,
        record=[*record, ident("data")] if whole else record,
        bad=builder.bad_sql() if targets is None else None,
        undecided_sql=builder.undecided_sql(),
    )


@dataclass
class _Slot:
    """A constant per event type, and for normalized values per term too."""

    name: str
    dtype: T.DataType
    term_sql: str | None = None
    by_type: dict[str, Any] = field(default_factory=dict)
    by_term: dict[tuple[str, str], Any] = field(default_factory=dict)


class _Builder:
    """Leaf expressions of each type, with the source columns and constants they use."""

    def __init__(
        self,
        mapping: EventMapping,
        body: Body,
        hooks: dict[str, Hook],
        declared: dict[tuple[str, ...], T.DataType],
    ):
        self.mapping = mapping
        self.body = body
        self.hooks = hooks
        self.declared = declared
        self._names: dict[str, str] = {}
        self._slots: dict[tuple, _Slot] = {}
        # each of these maps SQL text to the event types that use it
        self._sources: dict[str, list[str]] = {}
        self._bad: dict[str, list[str]] = {}
        self._undecided: dict[str, list[str]] = {}

    def leaves(self, rules: TypeRules) -> dict[tuple[str, ...], Typed]:
        written: dict[tuple[str, ...], list[Typed]] = {
            path: [self._static(rules.event_type, path, value)] for path, value in rules.statics.items()
        }
        for rule in rules.rules:
            source = self._source(rules.event_type, rule)
            for target in rule.targets:
                place = len(written.get(target.path, ()))
                value = self._value(rules, rule, target, source, place)
                if not target.blank:
                    written.setdefault(target.path, []).append(value)
        # Only non-null values are written, so the last write is the first
        # non-null one in reverse order.
        return {path: _last_non_null(values) for path, values in written.items()}

    def _source(self, event_type: str, rule: Rule) -> Typed:
        if rule.branches is None:
            sql, dtype = self.body.get(rule.source)
            if isinstance(dtype, T.VariantType) and rule.normalizes:
                sql = self._shared(sql, event_type)
            return Typed(sql, dtype or T.NullType())
        if not rule.branches:
            return Typed("NULL", T.NullType())
        picked = []
        for branch in rule.branches:
            test = condition_sql(branch.condition, self.body)
            sql, dtype = self.body.get(branch.source)
            picked.append((test, Typed(sql, dtype or T.NullType())))
            if may_be_undecided(branch.condition, self.body):
                _note(self._undecided, test, event_type)
        dtype = _common_type([v.dtype for _, v in picked])
        cases = " ".join(f"WHEN {test} THEN {_cast(v, dtype)}" for test, v in picked)
        return Typed(self._shared(f"CASE {cases} END", event_type), dtype)

    def _shared(self, sql: str, event_type: str) -> str:
        name = self._names.setdefault(sql, f"{_PREFIX}s{len(self._names)}")
        _note(self._sources, sql, event_type)
        return ident(name)

    def _slot(self, key: tuple, dtype: T.DataType, term_sql: str | None = None) -> _Slot:
        return self._slots.setdefault(key, _Slot(f"{_PREFIX}c{len(self._slots)}", dtype, term_sql))

    def _static(self, event_type: str, path: tuple[str, ...], value: Any) -> Typed:
        typed = _static(value)
        if value is None or isinstance(value, list):
            return typed
        slot = self._slot((path, "static", typed.dtype.simpleString()), typed.dtype)
        slot.by_type[event_type] = value
        return Typed(ident(slot.name), typed.dtype, nullable=False)

    def _value(self, rules: TypeRules, rule: Rule, target: Target, source: Typed, place: int) -> Typed:
        if rule.normalizes:
            if target.term is None and isinstance(source.dtype, T.VariantType):
                _note(self._bad, source.sql, rules.event_type)
            return self._normalized(rules, rule, target, source, place)
        if rule.transform in self.hooks and not isinstance(source.dtype, T.NullType):
            sql, dtype = self.hooks[rule.transform](_text_of(source), rule, target)
            return Typed(f"CASE WHEN {_text_of(source)} IS NOT NULL THEN {sql} END", dtype)
        if isinstance(source.dtype, T.VariantType):
            wanted = self.declared.get(target.path, T.StringType())
            cast = _cast(source, wanted)
            return Typed(f"CASE WHEN {_text_of(source)} IS NOT NULL THEN {cast} END", wanted)
        return source

    def _normalized(self, rules: TypeRules, rule: Rule, target: Target, source: Typed, place: int) -> Typed:
        terms = self.mapping.terms[rules.event_type]
        integer = rule.effective_output_type == "integer"
        dtype = T.IntegerType() if integer else T.StringType()

        def outcome(term: str | None) -> str | int:
            caption = rule.effective_prefix + terms.get(term, MISSING_CAPTION)
            if integer:
                return self.mapping.enum_id(rules.class_name, target.path, caption)
            return caption

        if isinstance(source.dtype, T.NullType) or target.blank:
            return Typed("NULL", dtype)
        if target.term is None and is_json_type(source.dtype):
            raise MappingError(
                f"{rules.event_type}/{rule.source_text}: a {source.dtype.simpleString()} cannot be normalized"
            )
        term_sql = _term_of(source) if target.term is None else None
        key = (target.path, place, term_sql, dtype.simpleString())
        slot = self._slot(key, dtype, term_sql)
        slot.by_type[rules.event_type] = outcome(target.term)
        if term_sql is None:
            value = ident(slot.name)
        else:
            found = {t: outcome(t) for t in terms if outcome(t) != outcome(None)}
            slot.by_term.update({(rules.event_type, t): v for t, v in found.items()})
            value = f"coalesce({ident(slot.name + 't')}, {ident(slot.name)})"
        return Typed(f"CASE WHEN {_text_of(source)} IS NOT NULL THEN {value} END", dtype)

    def source_columns(self, types: list[str]) -> list[str]:
        """Event type, conditional sources, and constants that need no lookup."""
        columns = [f"{self.body.type_sql()} AS {ident(_TYPE)}"]
        columns += [
            f"{_dispatch(self.body.type_sql(), dict.fromkeys(users, sql), types)} AS {ident(self._names[sql])}"
            for sql, users in self._sources.items()
        ]
        for slot in self._slots.values():
            if self._uniform(slot, types):
                columns.append(f"{literal(next(iter(slot.by_type.values())))} AS {ident(slot.name)}")
            if slot.term_sql and not slot.by_term:
                columns.append(f"CAST(NULL AS {slot.dtype.simpleString()}) AS {ident(slot.name + 't')}")
        return columns

    def lookups(self, types: list[str], values: list[str]) -> list[Lookup]:
        """The table of constants per type, then one per normalized source, with what the
        values mention."""
        tables = []
        mentioned = " ".join(values)
        used = [s for s in self._slots.values() if ident(s.name) in mentioned or ident(s.name + "t") in mentioned]
        varying = [s for s in used if not self._uniform(s, types)]
        if varying:
            schema = T.StructType().add(f"{_PREFIX}kt", T.StringType())
            for slot in varying:
                schema = schema.add(slot.name, slot.dtype)
            tables.append(Lookup(schema, [(t, *[s.by_type.get(t) for s in varying]) for t in types]))
        by_source: dict[str, list[_Slot]] = {}
        for slot in used:
            if slot.by_term:
                by_source.setdefault(slot.term_sql, []).append(slot)
        for number, (term_sql, slots) in enumerate(by_source.items()):
            schema = T.StructType()
            for name in (f"{_PREFIX}k{number}t", f"{_PREFIX}k{number}"):
                schema = schema.add(name, T.StringType())
            for slot in slots:
                schema = schema.add(slot.name + "t", slot.dtype)
            keys = list(dict.fromkeys(k for s in slots for k in s.by_term))
            tables.append(Lookup(schema, [(*k, *[s.by_term.get(k) for s in slots]) for k in keys], term_sql))
        return tables

    @staticmethod
    def _uniform(slot: _Slot, types: list[str]) -> bool:
        return set(slot.by_type) == set(types) and len(set(slot.by_type.values())) == 1

    def bad_sql(self) -> str | None:
        if not self._bad:
            return None
        reasons = []
        for source, users in self._bad.items():
            kind = f"schema_of_variant({source})"
            reasons.append(
                f"CASE WHEN {ident(_TYPE)} IN {in_list(users)} "
                f"AND ({kind} LIKE 'ARRAY<%' OR {kind} LIKE 'OBJECT<%') "
                f"THEN 'a list or object cannot be normalized' END"
            )
        return f"coalesce({', '.join(reasons)})"

    def undecided_sql(self) -> list[str]:
        return [
            f"({self.body.type_sql()} IN {in_list(users)} AND {test} IS NULL)"
            for test, users in self._undecided.items()
        ]


def _is_wanted(path: tuple[str, ...], targets: Collection[str] | None) -> bool:
    if targets is None:
        return True
    return any(path[: len(t)] == t for t in (tuple(target.split(".")) for target in targets))


def _note(users: dict[str, list[str]], sql: str, event_type: str) -> None:
    known = users.setdefault(sql, [])
    if event_type not in known:
        known.append(event_type)


def _text_of(value: Typed) -> str:
    """Value as it is tested for NULL; JSON null counts as NULL."""
    return f"CAST({value.sql} AS STRING)" if isinstance(value.dtype, T.VariantType) else value.sql


def _term_of(value: Typed) -> str:
    """Value as a term; anything but text never equals one, though its text might."""
    if isinstance(value.dtype, T.StringType):
        return value.sql
    if isinstance(value.dtype, T.VariantType):
        return f"CASE WHEN schema_of_variant({value.sql}) = 'STRING' THEN {_text_of(value)} END"
    return "CAST(NULL AS STRING)"


def _static(value: Any) -> Typed:
    if value is None:
        return Typed("NULL", T.NullType())
    if isinstance(value, bool):
        return Typed(literal(value), T.BooleanType(), nullable=False)
    if isinstance(value, int):
        fits = INT_MIN < value <= INT_MAX
        return Typed(literal(value), T.IntegerType() if fits else T.LongType(), nullable=False)
    if isinstance(value, float):
        return Typed(literal(value), T.DoubleType(), nullable=False)
    if isinstance(value, str):
        return Typed(literal(value), T.StringType(), nullable=False)
    members = [_static(v) for v in value]
    kinds = {m.dtype for m in members}
    if len(kinds) == 1 and not isinstance(members[0].dtype, (T.NullType, T.VariantType)):
        return Typed(f"array({', '.join(m.sql for m in members)})", T.ArrayType(members[0].dtype), nullable=False)
    return Typed(f"parse_json({literal(json.dumps(value))})", T.VariantType(), nullable=False)


def _last_non_null(values: list[Typed]) -> Typed:
    dtype = _common_type([v.dtype for v in values])
    chain = []
    for value in reversed(values):
        chain.append(_cast(value, dtype))
        if not value.nullable:
            break
    certain = any(not v.nullable for v in values)
    sql = chain[0] if len(chain) == 1 else f"coalesce({', '.join(chain)})"
    return Typed(sql, dtype, nullable=not certain)


def _in_order(per_type: dict[str, dict[tuple[str, ...], Typed]]) -> list[tuple[str, ...]]:
    return list(dict.fromkeys(path for leaves in per_type.values() for path in leaves))


def _common_type(dtypes: list[T.DataType]) -> T.DataType:
    """The one static type of a target; anything mixed becomes text."""

    def pair(left: T.DataType, right: T.DataType) -> T.DataType:
        if left == right or isinstance(right, T.NullType):
            return left
        if isinstance(left, T.NullType):
            return right
        if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
            return T.LongType()
        if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
            return T.DoubleType()
        return T.StringType()

    common = reduce(pair, dtypes)
    return T.StringType() if isinstance(common, T.NullType) else common


def _cast(value: Typed, dtype: T.DataType) -> str:
    if value.dtype == dtype:
        return value.sql
    target = dtype.simpleString()
    if isinstance(value.dtype, T.VariantType):
        return f"try_variant_get({value.sql}, {literal('$')}, {literal(target)})"
    if is_json_type(value.dtype) and isinstance(dtype, T.StringType):
        return f"to_json({value.sql})"
    if isinstance(dtype, T.VariantType):
        return f"CAST({value.sql} AS VARIANT)"
    return f"CAST({value.sql} AS {target})"


def _dispatch(type_sql: str, branches: dict[str, str], types: list[str]) -> str:
    """Pick the expression of the event's type; one expression for all needs no test."""
    by_sql: dict[str, list[str]] = {}
    for event_type, sql in branches.items():
        by_sql.setdefault(sql, []).append(event_type)
    if len(by_sql) == 1 and len(branches) == len(types):
        return next(iter(by_sql))
    cases = " ".join(f"WHEN {type_sql} IN {in_list(users)} THEN {sql}" for sql, users in by_sql.items())
    return f"CASE {cases} END"


def _as_epoch(sql: str, dtype: T.DataType, ignore_offset: bool) -> str:
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return f"unix_seconds(CAST({sql} AS TIMESTAMP))"
    if isinstance(dtype, T.TimestampNTZType):
        return f"unix_seconds(CAST({sql} AS TIMESTAMP))"
    if isinstance(dtype, T.NumericType):
        return f"CAST({sql} AS BIGINT)"
    if isinstance(dtype, (T.StringType, T.VariantType)):
        return epoch_sql(f"CAST({sql} AS STRING)", ignore_offset)
    return "CAST(NULL AS BIGINT)"
