"""Row filters of the ingest: time range, wanted types, mapped types, empty input."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.temporal import ISO_8601, SAFETY_LAG_MINUTES
from auditlake.sources.local import MAX_BROADCAST_ROWS, small
from auditlake.sources.raw import require_utc

DEFAULT_START = "2023-01-01T00:00:00.000Z"


def parse_instant(text: str) -> datetime:
    """Instant of ISO text; text without an offset is UTC."""
    value = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def format_instant(value: datetime) -> str:
    return value.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def upper_bound(now: str, lag_minutes: int = SAFETY_LAG_MINUTES) -> str:
    """Newest time that has settled: late events up to the lag have arrived."""
    return format_instant(parse_instant(now) - timedelta(minutes=lag_minutes))


def time_range(
    df: DataFrame,
    after: str | None,
    before: str | None,
    column: str = "created",
    *,
    inclusive_end: bool = False,
) -> DataFrame:
    """Keep rows with ``after < column < before``, both bounds open.

    A timestamp column is compared directly, so the range reaches the Parquet scan.
    ISO text is compared as an instant; a text range one day wider, which no UTC
    offset can cross, goes to the scan so that row groups are skipped there too.
    """
    require_utc(df.sparkSession)
    dtype = df.schema[column].dataType
    value = F.col(column)

    def bound(text: str):
        stamp = F.lit(text).cast("timestamp")
        return stamp.cast("timestamp_ntz") if isinstance(dtype, T.TimestampNTZType) else stamp

    def day(text: str, shift: int):
        return F.lit((parse_instant(text) + timedelta(days=shift)).strftime("%Y-%m-%d"))

    if isinstance(dtype, T.StringType):
        if after is not None:
            df = df.filter(value >= day(after, -1))
        if before is not None:
            df = df.filter(value < day(before, 2))
        df = df.filter(value.rlike(ISO_8601))
        value = F.try_to_timestamp(value)
    if after is not None:
        df = df.filter(value > bound(after))
    if before is not None:
        df = df.filter(value <= bound(before) if inclusive_end else value < bound(before))
    return df


def of_types(df: DataFrame, types: Iterable[str]) -> DataFrame:
    """Keep the wanted types; reaches the Parquet scan as ``In``."""
    return df.filter(F.col("type").isin(list(types)))


def drop_unmapped(df: DataFrame, mapped_types: DataFrame, rows: int | None = None) -> DataFrame:
    """Drop events whose type has no rules; ``rows`` is the known size of the lookup."""
    lookup = mapped_types.select("type")
    return df.join(small(lookup, MAX_BROADCAST_ROWS + 1 if rows is None else rows), "type", "left_semi")


def unmapped_only(df: DataFrame, mapped_types: DataFrame, rows: int | None = None) -> DataFrame:
    """The dropped side of :func:`drop_unmapped`."""
    lookup = mapped_types.select("type")
    return df.join(small(lookup, MAX_BROADCAST_ROWS + 1 if rows is None else rows), "type", "left_anti")


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard; stops at the first row."""
    return df.isEmpty()
