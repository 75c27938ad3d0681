"""Transforms of a mapping document as SQL functions of the session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from auditlake.functions.sqltext import ident
from auditlake.plans.compiler import Hook
from auditlake.plans.mapping import EventMapping, MappingError, Rule, Target


def sql_function(spark: SparkSession, function: str) -> Hook:
    """A hook that calls a SQL function of one text argument.

    A function made by ``CREATE FUNCTION ... RETURN`` is an expression that the optimizer
    puts in place of the call, so a hook costs what the expression costs. What it returns
    is asked of Spark once, when the hook is made; an unknown function is refused there.
    """
    name = ".".join(ident(part) for part in function.split("."))
    if not spark.catalog.functionExists(function):
        raise MappingError(f"there is no SQL function {function}")
    kind = spark.sql(f"SELECT {name}(CAST(NULL AS STRING)) AS value").schema["value"].dataType

    def hook(source: str, rule: Rule, target: Target) -> tuple[str, T.DataType]:
        return f"{name}(CAST({source} AS STRING))", kind

    return hook


def sql_functions(spark: SparkSession, functions: Mapping[str, str], mapping: EventMapping | None = None) -> dict[str, Hook]:
    """Hooks by the name of the transform, for SQL functions by their name.

    With the ``mapping`` that they are for, a transform of its rules that has none is refused.
    """
    if mapping is not None:
        rules = [r for kind in mapping.types.values() for r in kind.rules]
        named = {r.transform for r in rules if r.transform and not r.normalizes}
        if unknown := sorted(named - functions.keys()):
            raise MappingError(f"no hook for the transforms {unknown}")
    return {transform: sql_function(spark, function) for transform, function in functions.items()}
