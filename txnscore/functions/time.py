"""Event-time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c, fmt: str | None = None) -> Column:
    """Text -> wall-clock timestamp (``timestamp_ntz``); unparsable text gives
    NULL instead of failing (ANSI-safe). Parsing straight to a zone-less
    timestamp keeps the value independent of the session time zone (no
    daylight-saving gap can shift it)."""
    c = _c(c)
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return c.try_cast("timestamp_ntz")


def trans_hour(c) -> Column:
    """Hour of day, 0-23."""
    return F.hour(_c(c))


def trans_day_of_week(c) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(c))


def time_text(c) -> Column:
    """Event time as text for a message; a cast keeps the microseconds
    (``to_json`` of a timestamp would cut them to milliseconds)."""
    return _c(c).cast("string")


def _epoch_ntz() -> Column:
    """The epoch as a wall-clock (zone-less) timestamp."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def wall_to_instant(c) -> Column:
    """Wall-clock (``timestamp_ntz``) -> the instant with that UTC wall clock,
    whatever the session time zone (watermarks need a zoned timestamp)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(c)))


def instant_to_wall(c) -> Column:
    """Inverse of :func:`wall_to_instant`: the UTC wall clock of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), _epoch_ntz())
