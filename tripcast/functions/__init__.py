"""Scalar column functions (F1-F15), all built-in Spark expressions."""

from tripcast.functions.timefn import (
    ISO_TIMESTAMP_PATTERN, coerce_timestamp, duration_seconds, epoch_millis,
    from_epoch_millis, iso_string, iso_week_label, parse_iso_timestamp,
    time_of_day, to_ntz,
)
from tripcast.functions.numeric import (
    ratio, ratio_or_zero, truncate_int,
)

__all__ = [
    "ISO_TIMESTAMP_PATTERN", "coerce_timestamp", "duration_seconds", "epoch_millis",
    "from_epoch_millis", "iso_string", "iso_week_label", "parse_iso_timestamp",
    "time_of_day", "to_ntz", "ratio",
    "ratio_or_zero", "truncate_int",
]
