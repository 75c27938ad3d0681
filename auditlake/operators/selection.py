"""The row at a place of a sort order, found by counting instead of sorting.

The keys of some rows are drawn and cut the keys into ranges; rows are counted by range, and
only the range that holds the place is looked at in the next pass. A pass shuffles one count
per range from each task, so no task holds, sorts or receives the rows in front of the place.
A key that many rows share is drawn early and is a range of its own, so it ends the search.
Rows are drawn and not keys, as the rows of one key would all be drawn together: the passes
are then as many as the logarithm of the rows to the number drawn, whatever the repeats.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIVOTS = 63
FEW_ROWS = 10_000
MAX_PASSES = 100


@dataclass(frozen=True)
class Place:
    """The key at a place, and how many rows have a smaller one."""

    key: tuple
    before: int


def sort_key(column: Column, dtype: T.DataType) -> Column:
    """A value that orders as the column does and comes to the driver unchanged."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    return column


def is_before(columns: Sequence[Column], key: Sequence[Any]) -> Column:
    """Whether a row's key is smaller than a given one; NULL is the smallest value."""
    test = F.lit(False)
    for column, value in reversed(list(zip(columns, key, strict=True))):
        if value is None:
            test = column.isNull() & test
        else:
            test = column.isNull() | (column < F.lit(value)) | ((column == F.lit(value)) & test)
    return F.coalesce(test, F.lit(False))


def _is_key(columns: Sequence[Column], key: Sequence[Any]) -> Column:
    test = F.lit(True)
    for column, value in zip(columns, key, strict=True):
        test = test & column.eqNullSafe(F.lit(value))
    return test


def _sorting(key: Sequence[Any]) -> tuple:
    return tuple((value is not None, value if value is not None else 0) for value in key)


def _range_number(columns: Sequence[Column], pivots: Sequence[tuple]) -> Column:
    """Even numbers for what lies between pivots, odd ones for the pivots; a search tree."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        return (
            F.when(_is_key(columns, pivots[middle]), 2 * middle + 1)
            .when(is_before(columns, pivots[middle]), search(low, middle))
            .otherwise(search(middle + 1, high))
        )

    return search(0, len(pivots))


def nth_key(rows: DataFrame, keys: Sequence[Column], place: int, few: int | None = None) -> Place | None:
    """The key at a place, counted from 0, of rows sorted by their keys; None beyond the end.

    Keys must be numbers or text. Once at most ``few`` rows are left they are a top-n. The keys
    are kept on executor disks meanwhile; a lost block is read again.
    """
    names = [f"k{i}" for i in range(len(keys))]
    columns = [F.col(n) for n in names]
    left = rows.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)])
    few, before, n_left = FEW_ROWS if few is None else few, 0, None
    # computing the keys may cost far more than comparing them, and each pass reads them twice
    kept = left.persist(StorageLevel.DISK_ONLY)
    try:
        for turn in range(MAX_PASSES):
            if n_left is not None and n_left <= few:
                top = left.orderBy(*names).limit(place - before + 1)
                found = tuple(top.orderBy(*[F.desc_nulls_last(n) for n in names]).first())
                return Place(found, before + left.filter(is_before(columns, found)).count())
            drawn = left.orderBy(F.rand(turn)).limit(PIVOTS)
            pivots = sorted({tuple(r) for r in drawn.collect()}, key=_sorting)
            counts = left.groupBy(_range_number(columns, pivots).alias("range")).agg(F.count("*").alias("n"))
            for number, n in sorted(tuple(r) for r in counts.collect()):
                if before + n > place:
                    break
                before += n
            else:
                return None
            if number % 2:
                return Place(pivots[number // 2], before)
            at, n_left = number // 2, n
            if at < len(pivots):
                left = left.filter(is_before(columns, pivots[at]))
            if at > 0:
                left = left.filter(~is_before(columns, pivots[at - 1]) & ~_is_key(columns, pivots[at - 1]))
        raise RuntimeError(f"no place found in {MAX_PASSES} passes")
    finally:
        kept.unpersist()
