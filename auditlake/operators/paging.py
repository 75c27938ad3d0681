"""Sorted pages and bounded batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.temporal import instant
from auditlake.operators.selection import is_before, nth_key, sort_key

DEFAULT_LIMIT = 1_000
MAX_LIMIT = 10_000


def effective_limit(limit: int | str | None) -> int:
    """Text that is no integer gives the default; 0, None or too much the maximum."""
    if isinstance(limit, str):
        try:
            limit = int(limit)
        except ValueError:
            limit = DEFAULT_LIMIT
    if not limit or limit > MAX_LIMIT:
        return MAX_LIMIT
    if limit < 0:
        raise ValueError(f"limit must not be negative, is {limit}")
    return limit


def row_bound(limit: int | str | None) -> int | None:
    """Rows a bounded run takes: any positive number as it is; 0 or None is no bound."""
    if isinstance(limit, str):
        try:
            limit = int(limit)
        except ValueError:
            limit = DEFAULT_LIMIT
    if limit and limit < 0:
        raise ValueError(f"limit must not be negative, is {limit}")
    return limit or None


def effective_offset(offset: int | None) -> int:
    return 0 if not offset or offset < 0 else offset


def sorted_events(df: DataFrame, column: str = "created", tiebreak: str = "id") -> DataFrame:
    """Ascending by time; the tiebreak makes the order total."""
    return df.orderBy(column, tiebreak)


def page(
    df: DataFrame,
    limit: int | str | None = DEFAULT_LIMIT,
    offset: int | None = 0,
    column: str = "created",
    tiebreak: str = "id",
    shallow: int = MAX_LIMIT,
) -> DataFrame:
    """One page of the sorted events.

    Up to the offset ``shallow`` a page is a top-n: each task keeps ``offset + limit``
    rows. A deeper one first finds where it starts, without a sort of all rows.
    """
    limit, offset = effective_limit(limit), effective_offset(offset)
    if offset > shallow:
        df, offset = _from_offset(df, offset, column, tiebreak)
    return sorted_events(df, column, tiebreak).offset(offset).limit(limit)


def page_after(
    df: DataFrame,
    last: tuple[str, str] | None,
    limit: int | str | None = DEFAULT_LIMIT,
    column: str = "created",
    tiebreak: str = "id",
) -> DataFrame:
    """The page that follows a row, given by its time and tiebreak; None gives the first.

    However deep, it is a top-n over the rows behind that place, and the time reaches the
    scan. Rows equal in both are one place, so the tiebreak should be unique.
    """
    if last is not None:
        at, key = (F.lit(v).cast(df.schema[c].dataType) for v, c in zip(last, (column, tiebreak), strict=True))
        df = df.filter((F.col(column) >= at) & ((F.col(column) > at) | (F.col(tiebreak) > key)))
    return sorted_events(df, column, tiebreak).limit(effective_limit(limit))


def _from_offset(df: DataFrame, offset: int, column: str, tiebreak: str) -> tuple[DataFrame, int]:
    """Rows from the key at a deep offset on, and how many of them precede the offset.

    The key is found by counting; only counts and a few keys come to the driver.
    """
    keys = [sort_key(F.col(c), df.schema[c].dataType) for c in (column, tiebreak)]
    place = nth_key(df, keys, offset)
    if place is None:
        return df.filter(F.lit(False)), 0
    rest = df.filter(~is_before(keys, place.key))
    if place.key[0] is not None and isinstance(df.schema[column].dataType, T.StringType):
        # said on its own as well, as a plain comparison reaches the scan
        rest = rest.filter(F.col(column) >= F.lit(place.key[0]))
    return rest, offset - place.before


@dataclass
class Bounded:
    """A batch that ends on a whole timestamp, and the bound it ends at."""

    rows: DataFrame
    end: DataFrame


def bounded_batch(df: DataFrame, limit: int | str | None, column: str = "created") -> Bounded:
    """About ``limit`` oldest events, with every event that shares the last time.

    A page cut inside a group of equal times would lose the rest of the group once
    the position moves past it. The bound is the k-th time; a second scan takes all
    rows up to it. Up to ``MAX_LIMIT`` rows it is a top-n and ``end``, a one-row frame, a
    scalar subquery; a larger one is found at once, by counting ranges of time, so that
    no task holds so many rows.
    """
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    value = instant(f"`{column}`") if is_text else F.col(column)
    first = df.select(value.alias("at")).filter("at IS NOT NULL")
    bound = row_bound(limit)
    if bound is not None and bound > MAX_LIMIT:
        micros = sort_key(F.col("at"), first.schema["at"].dataType)
        place = nth_key(first, [micros], bound - 1)
        if place is not None:
            at = F.timestamp_micros(F.lit(place.key[0])).cast(first.schema["at"].dataType)
            return Bounded(df.filter(value <= at), df.sparkSession.range(1).select(at.alias("at")))
    elif bound is not None:
        first = first.orderBy("at").limit(bound)
    end = first.agg(F.max("at").alias("at"))
    return Bounded(df.filter(value <= end.scalar()), end)


def append_pages(*pages: DataFrame) -> DataFrame:
    """Pages after one another; repeated events stay repeated."""
    first, *rest = pages
    for following in rest:
        first = first.unionByName(following)
    return first
