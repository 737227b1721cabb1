"""Conversions between key strings, local wall-clock timestamps and epochs.

Keys are ``yyyy-MM-dd HH:mm:ss`` strings in local wall-clock time.  Inside
Spark they become TIMESTAMP_NTZ, so no session time zone shifts them; a zone
is applied only when an epoch is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the series are Eastern Prevailing Time wall-clock readings.
DEFAULT_ZONE = "America/New_York"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


KEY_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_key(key: str | Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP_NTZ; anything else gives null.

    Zone-free: ``to_timestamp`` would return a zoned TIMESTAMP and move the
    skipped DST hour when cast to NTZ.
    """
    c = _c(key)
    return F.when(c.rlike(KEY_PATTERN), c.try_cast("timestamp_ntz"))


def try_key_ts(key: str | Column) -> Column:
    """``try_cast(key as timestamp_ntz)``: lenient ISO parsing, null on bad input."""
    return _c(key).try_cast("timestamp_ntz")


def format_key(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ -> key string ``yyyy-MM-dd HH:mm:ss`` (seconds truncated).

    ``date_format`` on an NTZ value converts it through the session time zone
    first, which moves the skipped DST hour; the string cast does not.
    """
    return F.substring(_c(ts).cast("timestamp_ntz").cast("string"), 1, 19)


def epoch_seconds(ts: str | Column, zone: str = DEFAULT_ZONE) -> Column:
    """Epoch seconds of a local wall-clock NTZ value read in ``zone``.

    ``convert_timezone`` turns the wall clock into the UTC wall clock; on an
    NTZ value ``unix_timestamp`` then reads it as UTC in every session zone.
    """
    return F.unix_timestamp(F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(ts)))


def epoch_millis(ts: str | Column, zone: str = DEFAULT_ZONE) -> Column:
    return epoch_seconds(ts, zone) * F.lit(1000)


def day_bounds(day: str) -> tuple[str, str]:
    """A day ``YYYY-MM-DD`` -> inclusive key bounds of that day."""
    return f"{day} 00:00:00", f"{day} 23:59:59"
