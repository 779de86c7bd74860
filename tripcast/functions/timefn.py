"""Time functions (F1-F6, F10): all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripcast.config import NIGHT, TIME_OF_DAY_BUCKETS

# Accepted ISO-8601 grammar for event timestamps (K6):
# yyyy-MM-dd[(T| )HH[:mm[:ss[.f{1,6}]]][Z|+HH:MM|-HH:MM]]
ISO_TIMESTAMP_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
)


def parse_iso_timestamp(text: Column) -> Column:
    """ISO string -> TIMESTAMP, NULL when it is not ISO or not a real date (F1)."""
    return F.when(text.rlike(ISO_TIMESTAMP_PATTERN), F.try_to_timestamp(text))


def coerce_timestamp(text: Column) -> Column:
    """Lenient coercion of a datetime string, bad values -> NULL (V2)."""
    return F.try_to_timestamp(text)


def epoch_millis(ts: Column) -> Column:
    """TIMESTAMP -> epoch milliseconds (F2)."""
    return F.unix_millis(ts)


def from_epoch_millis(ms: Column) -> Column:
    """epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(ms)


def duration_seconds(start: Column, end: Column) -> Column:
    """Fractional seconds between two timestamps."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def time_of_day(ts: Column) -> Column:
    """Hour bucket of a timestamp: morning, noon, afternoon, evening, night."""
    hour = F.hour(ts)
    expr = None
    for start, end, name in TIME_OF_DAY_BUCKETS:
        cond = (hour >= start) & (hour < end)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(NIGHT))


def iso_week_label(ts: Column) -> Column:
    """ISO week label ``YYYY-Www`` using the ISO week-numbering year."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), ts).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(ts).cast("string"), 2, "0"),
    )


def iso_string(ts: Column) -> Column:
    """TIMESTAMP -> ISO text without zone, seconds precision."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def to_ntz(ts: Column) -> Column:
    """Wall-clock timestamp without zone, for tables compared with naive SQL."""
    return ts.cast("timestamp_ntz")
