"""Calendar features of a timestamp column (all built-in, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(ts: str | Column) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def hour_of_day(ts: str | Column = "ts") -> Column:
    return F.hour(_c(ts))


def day_of_week(ts: str | Column = "ts") -> Column:
    """1 = Sunday ... 7 = Saturday (Spark's DAYOFWEEK)."""
    return F.dayofweek(_c(ts))


def month_of_year(ts: str | Column = "ts") -> Column:
    return F.month(_c(ts))


def year_val(ts: str | Column = "ts") -> Column:
    return F.year(_c(ts))


def is_weekend(ts: str | Column = "ts") -> Column:
    """1 on Sunday or Saturday, else 0; a null timestamp gives 0, not null."""
    return F.when(F.dayofweek(_c(ts)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def hour_floor(ts: str | Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour without any time-zone round trip."""
    c = _c(ts)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


TIME_FEATURES = {
    "hour_of_day": hour_of_day,
    "day_of_week": day_of_week,
    "month_of_year": month_of_year,
    "year_val": year_val,
    "is_weekend": is_weekend,
}
