"""Adapters: derive the reference's datasets from the driver's tables.

The driver ships an ``events`` table (event_id, ts, user_id, event_type,
value, props).  These functions turn it into the hourly load series, the
hourly weather series, the raw weather CSV layout, a per-row series, keyed
upserts and stream messages.  Every adapter is a distributed aggregation or
projection, so its work grows with ``events``.

Hourly aggregation groups on the NTZ hour (a long), with map-side partial
aggregation, so a hot hour is combined before the shuffle; the key string
is formatted only on the small aggregated result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions.calendar import hour_floor
from loadcast.functions.timekeys import format_key
from loadcast.schemas import KEY, WEATHER_MEASURES


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_series(events: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Hourly load: (datetime_ept, mw) with mw = exact 2-dp sum of values (per series)."""
    return (
        events.groupBy(*series_keys, hour_floor("ts").alias("_h"))
        .agg(F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("mw"))
        .select(*series_keys, format_key("_h").alias(KEY), "mw")
    )


def weather_series(events: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Hourly weather from error events; some hours have none (left join nulls)."""
    n = F.count(F.lit(1))
    return (
        events.where(F.col("event_type") == "error")
        .groupBy(*series_keys, hour_floor("ts").alias("_h"))
        .agg(
            F.max("value").alias("TEMP"),
            F.when(n > 3, F.lit(0.5)).otherwise(F.lit(0.0)).alias("PRCP"),
            n.cast("double").alias("HMDT"),
            F.min("value").alias("WND_SPD"),
            (F.lit(1000) + n).cast("double").alias("ATM_PRESS"),
        )
        .select(*series_keys, format_key("_h").alias(KEY), *WEATHER_MEASURES)
    )


def raw_weather(weather: DataFrame) -> DataFrame:
    """Weather split back into YEAR/MO/DY/HR parts, the raw CSV layout."""
    ts = F.to_timestamp_ntz(F.col(KEY))
    return weather.select(
        F.year(ts).alias("YEAR"),
        F.month(ts).alias("MO"),
        F.dayofmonth(ts).alias("DY"),
        F.hour(ts).alias("HR"),
        *[F.col(m) for m in WEATHER_MEASURES],
    )


def event_series(events: DataFrame) -> DataFrame:
    """Per-row series: every event in (ts, event_id) order, value as mw."""
    return events.select("event_id", "ts", "user_id", F.col("value").alias("mw"))


def keyed_upserts(events: DataFrame) -> DataFrame:
    """Keyed cell updates: key user_id, seq event_id, cells value and props.

    ``value`` is null for views, so an older value must survive the merge.
    """
    return events.select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("double"))
        .otherwise(F.col("value"))
        .alias("value"),
        F.col("props"),
    )


def odd_load_messages(events: DataFrame) -> DataFrame:
    """(value, seq) load readings, some with a null, empty or unreadable key or broken JSON
    (``event_id`` 0, 1, 2, 3 modulo 50)."""
    turn = F.col("event_id") % 50
    key = F.when(turn == 1, "").when(turn == 2, "not a time").when(turn != 0, format_key(hour_floor("ts")))
    body = F.to_json(F.struct(key.alias("timestamp"), F.col("value").alias("current_reading")))
    return events.select(F.when(turn == 3, "{broken").otherwise(body).alias("value"), F.col("event_id").alias("seq"))
