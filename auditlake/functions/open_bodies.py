"""Key removal and the epoch pass over open bodies, VARIANT in and VARIANT out.

A value is taken apart one level at a time into its entries or items, these are worked on,
and it is put together again. The levels are written into one expression when the plan is
made, so nothing leaves the JVM; a body that is nested deeper than that raises an error
rather than pass half done.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlake.functions.sqltext import ident, literal
from auditlake.functions.temporal import epoch_sql

MAX_DEPTH = 12
_ROOT = literal("$")


def _entries(value: str) -> str:
    return f"try_variant_get({value}, {_ROOT}, 'map<string,variant>')"


def _items(value: str) -> str:
    return f"try_variant_get({value}, {_ROOT}, 'array<variant>')"


def _is_text(value: str, text: str) -> str:
    # an object or list casts to its whole JSON text, which would be written again at each level
    # above; a number casts to text as well, so the kind is asked for where the text is equal
    is_text = f"coalesce(try_variant_get({value}, {_ROOT}, 'string') = {text}, FALSE) AND schema_of_variant({value}) = 'STRING'"
    return f"({_items(value)} IS NULL AND {_entries(value)} IS NULL AND {is_text})"


def _with(name: str, value: str, then: str) -> str:
    """``then`` with a name for a value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def prune_open_sql(value: str, name: str, depth: int = MAX_DEPTH) -> str:
    wanted = literal(name)

    def pruned(value: str, left: int) -> str:
        t, k, x = (f"{c}{left}" for c in "tkx")
        is_leaf = f"{_entries(value)} IS NULL AND {_items(value)} IS NULL"
        if not left:
            told = f"raise_error('an open body is nested deeper than {depth} levels')"
            return f"CASE WHEN {is_leaf} THEN {value} ELSE CAST({told} AS VARIANT) END"
        kept = f"map_filter({_entries(value)}, ({k}, {x}) -> {k} <> {wanted} AND NOT {_is_text(x, wanted)})"
        # items under keys of their order, so that both are worked on by one expression; a
        # lambda in a lambda costs the analyzer some passes, so there is one a level
        listed = f"transform(filter({_items(value)}, {x} -> NOT {_is_text(x, wanted)}), ({x}, {k}) -> struct(CAST({k} AS STRING), {x}))"
        below = f"transform_values(coalesce({kept}, map_from_entries({listed})), ({k}, {x}) -> {pruned(x, left - 1)})"
        again = f"CASE WHEN {_entries(value)} IS NOT NULL THEN to_variant_object({t}) ELSE to_variant_object(map_values({t})) END"
        return f"CASE WHEN {is_leaf} THEN {value} ELSE {_with(t, below, again)} END"

    return pruned(value, depth)


def prune_open(column: str, name: str, depth: int = MAX_DEPTH) -> Column:
    """Drop entries whose key or text equals ``name`` and list items equal to it, everywhere.

    NULL stays NULL, a JSON null, a number or ``true`` is never equal, and an object or list
    that loses all it holds stays as an empty one.
    """
    return F.expr(prune_open_sql(ident(column), name, depth))


def epoch_open_sql(value: str, time_paths: Collection[tuple[str, ...]], ignore_offset: bool = False) -> str:
    tree: dict = {}
    for path in time_paths:
        at = tree
        for part in path:
            at = at.setdefault(part, {})

    def seconds(value: str) -> str:
        text = f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN try_variant_get({value}, {_ROOT}, 'string') END"
        return f"coalesce(CAST({epoch_sql(text, ignore_offset)} AS VARIANT), {value})"

    def walked(value: str, node: dict, level: int) -> str:
        m, k, x = (f"{c}{level}" for c in "mkx")
        cases = []
        for part, below in node.items():
            # what lies under ``data`` is the raw event and stays as it is
            if below and part != "data":
                cases.append(f"WHEN {literal(part)} THEN {walked(x, below, level + 1)}")
            elif not below:
                cases.append(f"WHEN {literal(part)} THEN {seconds(x)}")
        if not cases:
            return value
        done = f"transform_values({m}, ({k}, {x}) -> CASE {k} {' '.join(cases)} ELSE {x} END)"
        return _with(m, _entries(value), f"CASE WHEN {m} IS NULL THEN {value} ELSE to_variant_object({done}) END")

    return walked(value, tree, 0)


def epoch_open(column: str, time_paths: Collection[tuple[str, ...]], ignore_offset: bool = False) -> Column:
    """Turn the declared time fields of an open body into epoch seconds.

    Text that is no full ISO-8601 time stays as it is, as do other kinds of values. Lists
    are not entered, nor is a field named ``data``.
    """
    return F.expr(epoch_open_sql(ident(column), time_paths, ignore_offset))
