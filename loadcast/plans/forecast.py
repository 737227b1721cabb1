"""24-hour forecast built by the same feature code as training.

The reference scores 24 mock rows and names one feature differently from
training, so as checked in it cannot score.  Here the forecast frame is the
tail of the real history plus ``hours`` future hours, run through the same
calendar/weather/window feature functions, with what is unknown filled:

* ``load_lag_1h`` = lag 1, else lag 25 (the hour before, one day earlier), and
  so on a day at a time for longer horizons; ``load_lag_24h`` / ``load_lag_7d``
  likewise step back whole days / weeks beyond 24 / 168 hours ahead;
* ``TEMP`` = own value, else the value 24 rows back, else the last known;
  ``temp_lag_2h`` and ``temp_change_24h`` are then taken from filled TEMP;
* other weather measures take fixed defaults;
* lags 24 and 168 and the 7-day average come from history directly.

Only the tail (``history_rows``) is pulled out of the history, as a top-k
(each partition keeps its own best rows), so the window over the tail is a
few hundred rows no matter how long the history is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.timekeys import format_key
from loadcast.functions.weather import FORECAST_WEATHER_DEFAULTS
from loadcast.operators.features import (
    LAG_FEATURES,
    default_tie_break,
    time_features,
    weather_features,
    window_feature_exprs,
)
from loadcast.operators.sequence import global_windows
from loadcast.schemas import KEY, WEATHER_MEASURES

HOURS = 24


def history_tail(joined: DataFrame, rows: int, ts: str = "ts") -> DataFrame:
    ties = default_tie_break(joined, [ts])
    return joined.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in ties]).limit(rows)


def forecast_inputs(
    joined: DataFrame,
    start: dt.datetime | str | None = None,
    hours: int = HOURS,
    defaults: dict[str, float] | None = None,
    history_rows: int | None = None,
    avg_scale: int | None = None,
) -> DataFrame:
    """Feature rows for ``hours`` future hours after the history in ``joined``.

    ``start`` defaults to the last known hour + 1.  With a ``start``, only
    history before it is used; hours between the last known one and ``start``
    are filled with unknown rows, so row offsets stay hours, and the lags step
    back over them too.  ``joined`` is the output of ``join_raw`` (key, ts, mw,
    weather measures).
    """
    gap = 0
    if start is not None:
        first_hour = F.lit(str(start)).cast("timestamp_ntz")
        joined = joined.where(F.col("ts") < first_hour)
        # one scalar: how many hours are unknown before the forecast begins
        ahead = F.timestamp_diff("HOUR", F.max("ts"), first_hour) - 1
        gap = max(0, joined.agg(ahead).first()[0] or 0)
    ahead_hours = gap + hours
    defaults = FORECAST_WEATHER_DEFAULTS if defaults is None else defaults
    exprs, reach = window_feature_exprs(True, avg_scale)
    days, weeks = -(-ahead_hours // 24), -(-ahead_hours // 168)
    history_rows = history_rows or (168 * weeks + ahead_hours + 2)
    tail = history_tail(joined, history_rows).withColumn("_future", F.lit(False))

    # One row (the last known hour) drives the grid of future hours.
    grid_src = tail.agg(F.max("ts").alias("_last"))
    next_hour = F.col("_last") + F.expr("INTERVAL 1 HOUR")
    first = next_hour if start is None else F.lit(str(start)).cast("timestamp_ntz")
    begin = first if start is None else F.least(F.coalesce(next_hour, first), first)
    future_ts = F.explode(
        F.sequence(begin, first + F.make_interval(hours=F.lit(hours - 1)), F.expr("INTERVAL 1 HOUR"))
    )
    future = grid_src.select(future_ts.alias("ts")).select(
        format_key("ts").alias(KEY),
        "ts",
        F.lit(None).cast("double").alias("mw"),
        *[F.lit(None).cast("double").alias(m) for m in WEATHER_MEASURES],
        F.lit(True).alias("_future"),
    )
    both = tail.unionByName(future)

    w = Window.orderBy("ts", "_future")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    temp = F.coalesce(F.col("TEMP"), F.lag("TEMP", 24).over(w), F.last("TEMP", ignorenulls=True).over(upto))
    filled = both.withColumn("TEMP", temp)
    for m, v in defaults.items():
        filled = filled.withColumn(m, F.coalesce(F.col(m), F.lit(float(v))))

    feats = weather_features(time_features(filled))
    # Seasonal persistence for lags that point into the unknown future: the latest known hour a whole
    # number of days (or weeks) before.  Rows of one hour of the day (or week) are a window of their own,
    # so the plan doesn't grow with the horizon.  Up to 24 hours ahead only load_lag_1h ever steps back.
    lag1 = next(k for name, c, k in LAG_FEATURES if name == "load_lag_1h")
    feats = feats.withColumn("_i", F.row_number().over(w))

    def known(step: int, back: int) -> Column:
        """The latest known load of this row and the ``back`` ones each ``step`` rows earlier."""
        same_hour = Window.partitionBy(F.col("_i") % step).orderBy("_i")
        return F.last("mw", ignorenulls=True).over(same_hour.rowsBetween(-back, 0))

    feats = feats.withColumns({"_day_before": known(24, days), "_day": known(24, days - 1), "_week": known(168, weeks - 1)}).drop("_i")
    exprs["load_lag_1h"] = lambda w_: F.lag("_day_before", lag1).over(w_)
    exprs["load_lag_24h"] = lambda w_: F.lag("_day", 24).over(w_)
    exprs["load_lag_7d"] = lambda w_: F.lag("_week", 168).over(w_)
    out = global_windows(feats, exprs, ["ts", "_future"])
    if ahead_hours > 168:
        # Beyond a week the 7-day window holds only unknown hours: keep the last known average.
        upto_f = Window.orderBy("ts", "_future").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("load_ma_7d", F.last("load_ma_7d", ignorenulls=True).over(upto_f))
    asked = F.col("_future") if start is None else F.col("_future") & (F.col("ts") >= F.lit(str(start)).cast("timestamp_ntz"))
    return out.where(asked).drop("_future", "_day_before", "_day", "_week")


def forecast(model, inputs: DataFrame) -> DataFrame:
    """(ts, predicted_load_mw rounded to 2 dp) for the forecast rows."""
    from loadcast.ml.model import score

    return score(model, inputs).select("ts", F.round("prediction", 2).alias("predicted_load_mw"))


def append_predictions(preds: DataFrame, path: str, run_id: str) -> None:
    """Write one run's predictions as partition ``run_id``; rerunning a run replaces it."""
    (
        preds.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def seasonal_predictions(features: DataFrame) -> DataFrame:
    """A deterministic stand-in predictor: yesterday's load at the same hour."""
    return features.select("ts", F.round("load_lag_24h", 2).alias("predicted_load_mw"))
