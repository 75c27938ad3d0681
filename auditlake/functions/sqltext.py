"""Quoting for SQL text built from mapping documents.

Mapping documents are untrusted text, so every literal and identifier that
reaches ``selectExpr`` goes through this module.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def literal(value: str | int | float | bool | None) -> str:
    """SQL literal for a JSON scalar.

    ``$`` is written as a unicode escape because the Spark parser substitutes
    ``${name}`` in any SQL text, inside string literals too.
    """
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        if INT_MIN < value <= INT_MAX:
            return str(value)
        if LONG_MIN < value <= LONG_MAX:
            return f"{value}L"
        raise ValueError(f"integer {value} does not fit into 64 bits")
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"{value} is not a JSON number")
        return f"{value!r}D"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("$", "\\u0024")
    return f"'{escaped}'"


def ident(name: str) -> str:
    """Back-quoted identifier; a dot inside stays part of the name."""
    if "${" in name:
        raise ValueError(f"identifier {name!r} contains a substitution marker")
    return "`" + name.replace("`", "``") + "`"


def dotted(parts: Sequence[str]) -> str:
    """Struct field access, one quoted identifier per part."""
    return ".".join(ident(p) for p in parts)


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(literal(v) for v in values) + ")"


def variant_path(parts: Sequence[str]) -> str:
    """Quoted VARIANT path; every key is bracketed, so dots in keys are literal."""
    path = "$"
    for part in parts:
        quote = '"' if '"' not in part else "'"
        if quote in part:
            raise ValueError(f"key {part!r} mixes both quote characters")
        path += f"[{quote}{part}{quote}]"
    return literal(path)
