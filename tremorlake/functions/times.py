"""Conversions between epoch milliseconds, timestamps and text. The session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HOUR_MS = 3_600_000
NO_VALUE = "—"
_ISO = "yyyy-MM-dd HH:mm:ss"


def epoch_ms_to_ts(ms: Column) -> Column:
    """Milliseconds to TIMESTAMP; 0 means missing in the feed and becomes null."""
    return F.timestamp_millis(F.nullif(ms.cast("long"), F.lit(0).cast("long")))


def ts_to_epoch_ms(ts: Column) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ to whole milliseconds."""
    return F.unix_millis(ts.cast("timestamp"))


def ms_to_datetime(ms: Column) -> Column:
    """Milliseconds to TIMESTAMP, null stays null and 0 stays 1970."""
    return F.timestamp_millis(ms.cast("long"))


def to_iso(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, a dash for null and 0."""
    return F.coalesce(F.date_format(epoch_ms_to_ts(ms), _ISO), F.lit(NO_VALUE))


def normalize_time(time_ms: Column, time: Column, time_utc_text: Column) -> Column:
    """First usable time in milliseconds: ``time_ms``, ``time``, parsed text, else 0."""
    parsed = F.unix_millis(F.try_to_timestamp(time_utc_text))
    return F.coalesce(time_ms, time, parsed, F.lit(0).cast("long"))


def snap_to_hour(ms: Column, start_ms: int, end_ms: int) -> Column:
    """Nearest whole epoch hour, half up, kept inside [start, end]."""
    snapped = F.floor(ms / F.lit(float(HOUR_MS)) + F.lit(0.5)).cast("long") * F.lit(HOUR_MS)
    return F.least(F.greatest(snapped, F.lit(start_ms).cast("long")), F.lit(end_ms).cast("long"))
