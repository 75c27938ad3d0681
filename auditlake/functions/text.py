"""Text functions over paths, URLs and search literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlake.functions.sqltext import literal


def trim_all(text: Column) -> Column:
    """Strip every kind of whitespace; Spark's ``trim`` strips spaces only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return trim_all(text) == ""


def path_split(path: Column, separator: str = ".") -> Column:
    return F.split(path, f"[{separator}]")


def path_tail(path: Column, separator: str = ".") -> tuple[Column, Column]:
    """Last two parts of a path; the first of them is NULL for a one-part path."""
    parts = path_split(path, separator)
    return F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))


def enum_key(obj: Column, attribute: Column) -> Column:
    """Key text of an enum document row: ``('object', 'attribute')``."""
    return F.format_string("('%s', '%s')", obj, attribute)


def escape_literal(text: Column) -> Column:
    """Put a backslash before ``-``, ``.`` and ``:``."""
    return F.regexp_replace(text, r"([-.:])", r"\\$1")


def type_clause(types: Column) -> Column:
    """``type:A OR type:B`` from an array of type names."""
    labelled = F.transform(F.sort_array(types), lambda t: F.concat(F.lit("type:"), t))
    return F.array_join(labelled, " OR ")


def is_https(url: Column) -> Column:
    """Scheme test, any letter case; FALSE when there is no scheme."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)) == "https", F.lit(False))


def parse_conditions(text: str) -> dict[str, Column]:
    """Columns ``value``, ``negated``, ``path`` of condition text.

    ``not in`` is looked for first. Text without either operator gives NULLs.
    """
    negated = f"contains({text}, ' not in ')"
    plain = f"contains({text}, ' in ')"
    pieces = {}
    for name, picked in (
        ("value", "substring_index({t}, {op}, 1)"),
        ("path", "substring({t}, length(substring_index({t}, {op}, 1)) + length({op}) + 1)"),
    ):
        branches = " ".join(
            f"WHEN {test} THEN " + picked.format(t=text, op=literal(op))
            for test, op in ((negated, " not in "), (plain, " in "))
        )
        pieces[name] = F.expr(f"CASE {branches} END")
    pieces["negated"] = F.expr(f"CASE WHEN {negated} THEN TRUE WHEN {plain} THEN FALSE END")
    return pieces
