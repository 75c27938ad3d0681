"""Lookup joins with a default: term caption, prefix, enum id, type dispatch.

The mapping compiler folds these lookups into constants. This is the relational
form, for lookups kept in tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions.text import path_tail
from auditlake.plans.mapping import MISSING_CAPTION, MISSING_ENUM_ID
from auditlake.sources.local import small


def normalize_term(
    df: DataFrame,
    terms: DataFrame,
    term: str,
    rows: int,
    *,
    output: str = "caption",
    hit: str | None = None,
) -> DataFrame:
    """Add the caption of ``(type, term)``; a miss gives ``Other``, a NULL term NULL.

    ``hit`` names an optional column telling a found term from a miss.
    """
    lookup = terms.select(F.col("type"), F.col("term").alias(term), F.col("caption").alias("__caption"))
    joined = df.join(small(lookup, rows), ["type", term], "left")
    caption = F.when(F.col(term).isNotNull(), F.coalesce("__caption", F.lit(MISSING_CAPTION)))
    columns = {output: caption}
    if hit:
        columns[hit] = F.col("__caption").isNotNull()
    return joined.withColumns(columns).drop("__caption")


def prefixed(caption: Column, prefix: Column | str) -> Column:
    """Prefix and caption, joined before any enum lookup."""
    return F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, caption)


def enum_object(class_name: Column, attribute: Column) -> tuple[Column, Column]:
    """Enum key of an attribute path: its last two parts, or the class and the one part."""
    parent, leaf = path_tail(attribute)
    return F.coalesce(parent, class_name), leaf


def enum_id(
    df: DataFrame,
    enums: DataFrame,
    class_name: Column,
    attribute: Column,
    caption: str,
    rows: int,
    *,
    output: str = "enum_id",
) -> DataFrame:
    """Add the enum id of a caption; a miss gives 0, a NULL caption NULL."""
    obj, leaf = enum_object(class_name, attribute)
    keyed = df.withColumns({"__object": obj, "__attribute": leaf})
    lookup = enums.select(
        F.col("object").alias("__object"),
        F.col("attribute").alias("__attribute"),
        F.col("caption").alias(caption),
        F.col("id").alias("__id"),
    )
    joined = keyed.join(small(lookup, rows), ["__object", "__attribute", caption], "left")
    found = F.when(F.col(caption).isNotNull(), F.coalesce("__id", F.lit(MISSING_ENUM_ID)))
    return joined.withColumn(output, found).drop("__object", "__attribute", "__id")


def dispatch(df: DataFrame, types: DataFrame, rows: int) -> DataFrame:
    """Attach the class of each event's type; events without one are dropped."""
    return df.join(small(types, rows), "type", "inner")
