"""Serving queries over the keyed tables (re-aimed read endpoints).

Each endpoint is a DataFrame query: a key range scan, typed cells, output
names as the endpoints return them; on a table partitioned by the key's day the
range prunes whole days; ``combined`` joins forecast, actual load
and weather by hour and adds the absolute error.  Keys are unique per table
(they come out of the keyed merge), so "first match" is "the match".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.display import time_of_day, two_dp
from loadcast.functions.timekeys import DEFAULT_ZONE, day_bounds, epoch_seconds, format_key
from loadcast.operators.kv import DAY, latest_run, range_scan


def _num(c: str, to: str = "double"):
    # Cells may arrive as text from a string-typed store; missing -> null.
    return F.col(c).try_cast(to)


def _between(kv: DataFrame, start: str, stop: str, key: str) -> DataFrame:
    """The key range, by whole days first if the table knows its keys' days."""
    return range_scan(kv, start, stop, key, DAY if DAY in kv.columns else None)


def predictions_kv(preds: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Predictions table -> keyed layout (row_key, prediction_value, prediction_ts), one row per key: the latest run's."""
    return latest_run(preds).select(
        format_key("ts").alias("row_key"),
        F.col("predicted_load_mw").alias("prediction_value"),
        epoch_seconds("ts", zone).alias("prediction_ts"),
    )


def predictions(kv: DataFrame, start: str, stop: str, key: str = "row_key") -> DataFrame:
    return _between(kv, start, stop, key).select(
        F.col(key).alias("datetime"),
        _num("prediction_ts", "bigint").alias("timestamp"),
        _num("prediction_value").alias("predictedLoad"),
    )


def actual_load(kv: DataFrame, start: str, stop: str, key: str = "key") -> DataFrame:
    return _between(kv, start, stop, key).select(
        F.col(key).alias("datetime"),
        _num("timestamp_ms", "bigint").alias("timestamp"),
        _num("current_reading").alias("actualLoad"),
    )


def weather(kv: DataFrame, start: str, stop: str, key: str = "key") -> DataFrame:
    return _between(kv, start, stop, key).select(
        F.col(key).alias("datetime"),
        _num("temp").alias("temperature"),
        _num("hmdt").alias("humidity"),
        _num("atm_press").alias("pressure"),
        _num("wnd_spd").alias("windSpeed"),
        _num("prcp").alias("precipitation"),
    )


def combined(
    pred_kv: DataFrame,
    load_kv: DataFrame,
    weather_kv: DataFrame,
    date: str | None = None,
    start: str | None = None,
    stop: str | None = None,
    join: str | None = None,
) -> DataFrame:
    """Forecast with its actual load, error and weather, one row per forecast hour.

    ``join="merge"`` on tables in equal buckets of their key (``operators.bucketed``)
    joins them bucket by bucket, without a shuffle.

    ``date`` (``YYYY-MM-DD``) selects one day as the endpoint does; or give
    ``start``/``stop``; with neither, every forecast hour.  The same range
    filter is applied to all three tables before the joins.
    """
    if date is not None:
        start, stop = day_bounds(date)
    if start is not None and stop is not None:
        pred_kv = _between(pred_kv, start, stop, "row_key")
        load_kv, weather_kv = (_between(kv, start, stop, "key") for kv in (load_kv, weather_kv))
    p = pred_kv.select(F.col("row_key").alias("_k"), _num("prediction_value").alias("predicted"))
    a = load_kv.select(F.col("key").alias("_k"), _num("current_reading").alias("actual"))
    w = weather_kv.select(
        F.col("key").alias("_k"),
        _num("temp").alias("temp"),
        _num("hmdt").alias("humidity"),
        _num("wnd_spd").alias("windSpeed"),
    )
    if join:
        p, a, w = (x.hint(join) for x in (p, a, w))
    j = p.join(a, "_k", "left").join(w, "_k", "left")
    return j.select(
        F.col("_k").alias("datetime"),
        "predicted",
        "actual",
        F.abs(F.col("predicted") - F.col("actual")).alias("error"),
        "temp",
        "humidity",
        "windSpeed",
    )


def dashboard(comb: DataFrame, zero_as_na: bool = False) -> DataFrame:
    """Table rows of the dashboard: time of day and 2-dp text, N/A for missing."""
    return comb.select(
        "datetime",
        time_of_day("datetime").alias("time"),
        two_dp("predicted").alias("predicted"),  # the page shows 0 here; only null is N/A
        two_dp("actual", zero_as_na).alias("actual"),
        two_dp("error", zero_as_na).alias("error"),
        two_dp("temp", zero_as_na).alias("temperature"),
        two_dp("humidity", zero_as_na).alias("humidity"),
    )
