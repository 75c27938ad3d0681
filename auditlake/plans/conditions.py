"""Mapping conditions as SQL predicates.

``value in path`` means substring of text, member of a list, or key of an object,
by the type found at the path. A falsy value (missing, null, empty, zero, false)
is read as the text ``System`` first. A number or ``true`` gives NULL, which no
branch takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.nested import Body, body_of
from auditlake.functions.sqltext import ident, literal
from auditlake.plans.mapping import Condition, parse_condition

FALSY_DEFAULT = "System"


def condition_sql(condition: Condition, body: Body) -> str:
    """Predicate: TRUE, FALSE, or NULL where the test is not defined."""
    field, dtype = body.get(condition.path)
    positive = _membership(condition.value, field, dtype)
    return f"(NOT ({positive}))" if condition.negated else f"({positive})"


def condition_column(text: str, df: DataFrame, variant_column: str | None = None) -> Column:
    """Predicate of condition text over raw events."""
    return F.expr(condition_sql(parse_condition(text), body_of(df, variant_column)))


def may_be_undecided(condition: Condition, body: Body) -> bool:
    """Whether the type at the path allows values the test is not defined for."""
    _, dtype = body.get(condition.path)
    return isinstance(dtype, (T.BooleanType, T.NumericType, T.VariantType))


def _membership(value: str, field: str, dtype: T.DataType | None) -> str:
    default = literal(value in FALSY_DEFAULT)
    wanted = literal(value)
    if dtype is None or isinstance(dtype, T.NullType):
        return default
    if isinstance(dtype, T.StringType):
        return f"contains(coalesce(nullif({field}, ''), {literal(FALSY_DEFAULT)}), {wanted})"
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN coalesce({field}, FALSE) THEN NULL ELSE {default} END"
    if isinstance(dtype, T.NumericType):
        return f"CASE WHEN coalesce({field}, 0) = 0 THEN {default} END"
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.StringType):
            found = f"coalesce(array_contains({field}, {wanted}), FALSE)"
        elif isinstance(dtype.elementType, T.VariantType):
            found = f"coalesce({_member(field, wanted)}, FALSE)"
        else:
            found = "FALSE"
        return f"CASE WHEN coalesce(size({field}), -1) <= 0 THEN {default} ELSE {found} END"
    if isinstance(dtype, T.MapType):
        if not isinstance(dtype.keyType, T.StringType):
            return f"CASE WHEN coalesce(size({field}), -1) <= 0 THEN {default} ELSE FALSE END"
        return (
            f"CASE WHEN coalesce(size({field}), -1) <= 0 THEN {default} "
            f"ELSE map_contains_key({field}, {wanted}) END"
        )
    if isinstance(dtype, T.StructType):
        # in a declared struct a NULL field stands for an absent key
        present = " OR ".join(f"{field}.{ident(n)} IS NOT NULL" for n in dtype.fieldNames())
        held = f"{field}.{ident(value)} IS NOT NULL" if value in dtype.fieldNames() else "FALSE"
        return f"CASE WHEN {field} IS NULL OR NOT ({present}) THEN {default} ELSE {held} END"
    if isinstance(dtype, T.VariantType):
        return _variant_membership(wanted, field, default)
    return f"contains(coalesce(CAST({field} AS STRING), {literal(FALSY_DEFAULT)}), {wanted})"


def _member(items: str, wanted: str) -> str:
    return f"exists({items}, e -> schema_of_variant(e) = 'STRING' AND CAST(e AS STRING) = {wanted})"


def _variant_membership(wanted: str, field: str, default: str) -> str:
    # The type is tested before any cast: an object casts to its JSON text, which
    # would match as a substring.
    kind = f"schema_of_variant({field})"
    items = f"try_variant_get({field}, {literal('$')}, 'array<variant>')"
    keys = f"try_variant_get({field}, {literal('$')}, 'map<string,variant>')"
    text = f"CAST({field} AS STRING)"
    member = _member(items, wanted)
    return (
        f"CASE WHEN {field} IS NULL OR {kind} = 'VOID' THEN {default} "
        f"WHEN {kind} = 'STRING' THEN contains(coalesce(nullif({text}, ''), {literal(FALSY_DEFAULT)}), {wanted}) "
        f"WHEN {kind} LIKE 'ARRAY<%' THEN CASE WHEN size({items}) = 0 THEN {default} ELSE {member} END "
        f"WHEN {kind} LIKE 'OBJECT<%' THEN "
        f"CASE WHEN size({keys}) = 0 THEN {default} ELSE map_contains_key({keys}, {wanted}) END "
        f"WHEN {kind} = 'BOOLEAN' THEN CASE WHEN CAST({field} AS BOOLEAN) THEN NULL ELSE {default} END "
        f"WHEN try_variant_get({field}, {literal('$')}, 'double') = 0 THEN {default} END"
    )
