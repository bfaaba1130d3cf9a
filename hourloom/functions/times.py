"""Local times, UTC hours and epoch seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.functions.casts import as_column, lenient_double


def offset_to_zone(hours: Column | str) -> Column:
    """Whole-hour offset to a fixed zone id: -6 gives ``UTC-06:00``, 0 gives ``UTC``."""
    h = as_column(hours)
    return F.when(h == 0, F.lit("UTC")).when(h.isNotNull(), F.format_string("UTC%+03d:00", h))


def parse_local(text: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp; text that does not fit the pattern (hour 24, say) gives null."""
    c = as_column(text)
    return F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c)


def local_to_utc(ts: Column | str, zone: Column | str) -> Column:
    """Wall-clock time at ``zone`` (offset or region id, per row) to UTC."""
    return F.to_utc_timestamp(as_column(ts), as_column(zone))


def utc_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", as_column(ts))


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_seconds(as_column(ts).cast("timestamp"))


def arrival_hour(depart: Column | str, minutes: Sequence[Column | str], truncate_first: bool = True) -> Column:
    """Hour reached after adding ``minutes`` to ``depart``.

    With ``truncate_first`` the clock starts at the full departure hour, so the
    result can be up to an hour early; turn it off to count from the exact time.
    """
    start = utc_hour(depart) if truncate_first else as_column(depart)
    seconds = epoch_seconds(start).cast("double")
    for part in minutes:
        seconds = seconds + lenient_double(part) * 60
    return utc_hour(F.timestamp_seconds(seconds))
