"""Nested reads and writes: path lookup, record assembly, key pruning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.sqltext import dotted, ident, literal, variant_path


@dataclass(frozen=True)
class StructBody:
    """Raw events whose fields are the columns of the frame."""

    schema: T.StructType

    def get(self, parts: Sequence[str]) -> tuple[str, T.DataType | None]:
        """SQL text and type at a path; ``("NULL", None)`` once a step is missing."""
        dtype: T.DataType = self.schema
        sql = ""
        for depth, part in enumerate(parts):
            if isinstance(dtype, T.VariantType):
                return f"try_variant_get({sql}, {variant_path(parts[depth:])}, 'variant')", dtype
            if isinstance(dtype, T.StructType) and part in dtype.fieldNames():
                dtype = dtype[part].dataType
                sql = f"{sql}.{ident(part)}" if sql else ident(part)
            elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
                dtype = dtype.valueType
                sql = f"try_element_at({sql}, {literal(part)})"
            else:
                return "NULL", None
        return sql, dtype

    def type_sql(self) -> str:
        return ident("type")

    def whole_sql(self) -> str:
        pairs = ", ".join(f"{literal(n)}, {ident(n)}" for n in self.schema.fieldNames())
        return f"named_struct({pairs})"


@dataclass(frozen=True)
class VariantBody:
    """Raw events of open shape, held in one VARIANT column."""

    column: str = "body"

    def get(self, parts: Sequence[str]) -> tuple[str, T.DataType | None]:
        return (
            f"try_variant_get({ident(self.column)}, {variant_path(parts)}, 'variant')",
            T.VariantType(),
        )

    def type_sql(self) -> str:
        return f"try_variant_get({ident(self.column)}, {variant_path(['type'])}, 'string')"

    def whole_sql(self) -> str:
        return ident(self.column)


Body = StructBody | VariantBody


def body_of(df: DataFrame, variant_column: str | None = None) -> Body:
    return VariantBody(variant_column) if variant_column else StructBody(df.schema)


def nested_get(body: Body, parts: Sequence[str], as_type: str | None = None) -> Column:
    """Value at a path, NULL as soon as a step is missing or no object."""
    sql, dtype = body.get(parts)
    if isinstance(dtype, T.VariantType) and isinstance(body, VariantBody):
        wanted = as_type or "string"
        return F.expr(
            f"try_variant_get({ident(body.column)}, {variant_path(parts)}, {literal(wanted)})"
        )
    column = F.expr(sql)
    return column.cast(as_type) if as_type else column


@dataclass
class Leaf:
    """One value of a record: SQL text, and whether it can be NULL."""

    sql: str
    nullable: bool = True


def assemble(leaves: Mapping[tuple[str, ...], Leaf]) -> list[tuple[str, Leaf]]:
    """Top-level columns of a record from its leaf paths.

    An object whose leaves are all NULL becomes NULL itself, so its key is absent
    from the JSON text.
    """
    tree: dict[str, dict | Leaf] = {}
    for path, leaf in leaves.items():
        node = tree
        for part in path[:-1]:
            node = node.setdefault(part, {})
            if not isinstance(node, dict):
                raise ValueError(f"{'.'.join(path)} lies below a value")
        if path[-1] in node:
            raise ValueError(f"{'.'.join(path)} is written twice, or lies above another value")
        node[path[-1]] = leaf

    def build(node: dict | Leaf) -> tuple[Leaf, list[str]]:
        if isinstance(node, Leaf):
            return node, [node.sql] if node.nullable else []
        pairs, tests, certain = [], [], False
        for name, child in node.items():
            leaf, child_tests = build(child)
            pairs.append(f"{literal(name)}, {leaf.sql}")
            tests += child_tests
            certain = certain or not leaf.nullable
        built = f"named_struct({', '.join(pairs)})"
        if certain:
            return Leaf(built, nullable=False), []
        present = " OR ".join(f"{t} IS NOT NULL" for t in tests)
        return Leaf(f"CASE WHEN {present} THEN {built} END"), tests

    return [(name, build(child)[0]) for name, child in tree.items()]


def nested_set(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Record with each SQL expression placed at its dotted path."""
    leaves = {tuple(path.split(".")): Leaf(sql) for path, sql in values.items()}
    return df.selectExpr(*[f"{leaf.sql} AS {ident(name)}" for name, leaf in assemble(leaves)])


def is_json_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.MapType, T.ArrayType))


def prune_key(column: Column, dtype: T.DataType, name: str) -> Column:
    """Drop entries whose key or value equals ``name``, and equal list elements.

    A struct that loses all its fields becomes a text NULL. A VARIANT is refused.

    NULL values and elements stay: the comparison is null-safe.
    """
    if isinstance(dtype, T.StructType):
        kept = [f for f in dtype.fields if f.name != name]
        if not kept:
            # nothing is left of the object, and a struct needs one field
            return F.lit(None).cast(T.StringType())
        fields = [prune_value(column.getField(f.name), f.dataType, name).alias(f.name) for f in kept]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(column, lambda k, v: _differs(k, dtype.keyType, name) & _differs(v, dtype.valueType, name))
        if _has_nested(dtype.valueType):
            return F.transform_values(kept, lambda _, v: prune_key(v, dtype.valueType, name))
        return kept
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(column, lambda e: _differs(e, dtype.elementType, name))
        if _has_nested(dtype.elementType):
            return F.transform(kept, lambda e: prune_key(e, dtype.elementType, name))
        return kept
    if isinstance(dtype, T.VariantType):
        raise TypeError(f"entries of a VARIANT cannot be dropped; give {name!r}'s column a declared type first")
    return column


def prune_value(column: Column, dtype: T.DataType, name: str) -> Column:
    """Value of a struct field: NULL (absent) when it equals ``name``."""
    if isinstance(dtype, T.StringType):
        return F.when(~column.eqNullSafe(F.lit(name)), column)
    return prune_key(column, dtype, name)


def _differs(column: Column, dtype: T.DataType, name: str) -> Column:
    if isinstance(dtype, T.StringType):
        return ~column.eqNullSafe(F.lit(name))
    return F.lit(True)


def _has_nested(dtype: T.DataType) -> bool:
    return is_json_type(dtype)


def prune_frame(df: DataFrame, name: str) -> DataFrame:
    """Apply :func:`prune_key` to the whole record."""
    kept = [f for f in df.schema.fields if f.name != name]
    return df.select(
        *[prune_value(df[dotted([f.name])], f.dataType, name).alias(f.name) for f in kept]
    )
