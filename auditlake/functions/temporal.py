"""Time functions: text to epoch seconds, ISO text, partition day, day age.

The functions take SQL expression text (usually a column name) and give a
``Column``. They read clock fields in the session time zone, which must be UTC;
``sources.raw.require_utc`` checks that.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.sqltext import literal

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DAY_PATTERN = "yyyyMMdd"
SAFETY_LAG_MINUTES = 60

# Spark also parses "12:30" (as today) and "2023"; only full dates may pass.
ISO_8601 = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)


def instant_sql(text: str) -> str:
    """Timestamp of ISO-8601 text; NULL for anything else.

    The text is mentioned once, as a filter computes each mention of it again.
    """
    return f"try_to_timestamp(regexp_extract({text}, {literal(ISO_8601)}, 0))"


def epoch_sql(text: str, ignore_offset: bool = False) -> str:
    """Epoch seconds, floored, of ISO-8601 text.

    ``ignore_offset`` reads the wall clock and drops any UTC offset.
    """
    if ignore_offset:
        return (
            f"CASE WHEN {text} RLIKE {literal(ISO_8601)} "
            f"THEN unix_seconds(CAST(try_cast({text} AS TIMESTAMP_NTZ) AS TIMESTAMP)) END"
        )
    return f"unix_seconds({instant_sql(text)})"


def instant(text: str) -> Column:
    return F.expr(instant_sql(text))


def to_epoch(text: str, ignore_offset: bool = False) -> Column:
    return F.expr(epoch_sql(text, ignore_offset))


def event_day(text: str) -> Column:
    """``yyyyMMdd`` of ISO text; NULL when the text is no date."""
    return F.date_format(instant(text), DAY_PATTERN)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with millis and ``Z``."""
    return F.date_format(ts, ISO_PATTERN)


def minus_minutes(ts: Column, minutes: int = SAFETY_LAG_MINUTES) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Whole days, floored, so one second before ``earlier`` is day -1."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def older_than_day(now: Column, then: Column) -> Column:
    return whole_days_between(now, then) > 0


def clamp_position(saved: Column, now: Column, lag_minutes: int = SAFETY_LAG_MINUTES) -> Column:
    """Saved position, or ``now - lag`` when none is saved or it is a day behind."""
    upper = minus_minutes(now, lag_minutes)
    return F.when(saved.isNull() | older_than_day(upper, saved), upper).otherwise(saved)


def epoch_all_fields(
    df: DataFrame, time_paths: Collection[tuple[str, ...]], ignore_offset: bool = False
) -> DataFrame:
    """Turn the declared time fields of a nested record into epoch seconds.

    The walk happens on the schema, at plan time. It does not enter a field named
    ``data``, nor lists.
    """
    wanted = set(time_paths)

    def holds_time(path: tuple[str, ...]) -> bool:
        return any(p[: len(path)] == path for p in wanted)

    def walk(column: Column, dtype: T.DataType, path: tuple[str, ...]) -> Column:
        if isinstance(dtype, T.StructType):
            if path[-1] == "data" or not holds_time(path):
                return column
            fields = [
                walk(column.getField(f.name), f.dataType, (*path, f.name)).alias(f.name)
                for f in dtype.fields
            ]
            return F.when(column.isNotNull(), F.struct(*fields))
        if path in wanted and isinstance(dtype, T.StringType):
            iso = column.rlike(ISO_8601)
            if ignore_offset:
                parsed = column.try_cast("timestamp_ntz").cast("timestamp")
            else:
                parsed = F.try_to_timestamp(column)
            return F.unix_seconds(F.when(iso, parsed))
        return column

    return df.select(
        *[walk(df[f"`{f.name}`"], f.dataType, (f.name,)).alias(f.name) for f in df.schema.fields]
    )
