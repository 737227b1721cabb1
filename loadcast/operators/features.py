"""The feature chain: join, calendar and weather features, row-window features.

One function set serves training and forecasting, so the model always sees
the same columns under the same names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.calendar import TIME_FEATURES
from loadcast.functions.timekeys import try_key_ts
from loadcast.functions.weather import WEATHER_FEATURES
from loadcast.operators.sequence import DEFAULT_BLOCK, Staged, global_windows, halo_windows, sized_sequence
from loadcast.schemas import KEY, WEATHER_MEASURES

# Window features of the reference (output name, source column, rows back).
LAG_FEATURES = [
    ("load_lag_1h", "mw", 1),
    ("load_lag_24h", "mw", 24),
    ("load_lag_7d", "mw", 168),
    ("temp_lag_2h", "TEMP", 2),
]
CHANGE_FEATURES = [("temp_change_24h", "TEMP", 24)]
MOVING_AVG_FEATURES = [("load_ma_7d", "mw", 168)]
WARMUP_COLUMN = "load_lag_7d"


def join_raw(load: DataFrame, weather: DataFrame, key: str = KEY, series_keys: Sequence[str] = ()) -> DataFrame:
    """Load LEFT JOIN weather on the key string, plus the parsed NTZ ``ts``.

    Load hours without weather keep null measures.  A key repeated on both
    sides (the repeated DST hour) fans out n x m, as an equi-join does.
    With ``series_keys`` (several series in one table) they join too.  The
    join strategy is left to AQE: it broadcasts weather only when the
    measured side is below the broadcast threshold.
    """
    # Qualified names through aliases: both sides may come from one aggregate (a self-join).
    l = load.select(*series_keys, F.col(key), F.col("mw")).alias("_l")
    w = weather.select(
        *[F.col(k).alias(f"_w_{k}") for k in series_keys], F.col(key).alias("_wkey"), *WEATHER_MEASURES
    ).alias("_w")
    cond = F.col(f"_l.{key}") == F.col("_w._wkey")
    for k in series_keys:
        cond = cond & (F.col(f"_l.{k}") == F.col(f"_w._w_{k}"))
    return l.join(w, cond, "left").select(
        *[F.col(f"_l.{k}").alias(k) for k in series_keys],
        F.col(f"_l.{key}").alias(key),
        try_key_ts(F.col(f"_l.{key}")).alias("ts"),
        F.col("_l.mw").alias("mw"),
        *[F.col(f"_w.{m}").alias(m) for m in WEATHER_MEASURES],
    )


def time_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.select("*", *[fn(ts).alias(name) for name, fn in TIME_FEATURES.items()])


def weather_features(df: DataFrame) -> DataFrame:
    return df.select("*", *[fn().alias(name) for name, fn in WEATHER_FEATURES.items()])


def moving_avg(col: str, lo: int, hi: int, scale: int | None):
    """Average of ``col`` over rows ``[i+lo, i+hi]`` (``lo <= hi <= 0``).

    With ``scale``: the difference of two running sums of the value in exact
    integer units of 10^-scale (and of two running counts), so each row costs
    O(1) instead of O(frame), and the result is exact: equal to the DECIMAL
    frame sum divided by the count, whatever the block layout.
    Needs ``1 - lo`` rows of reach.  A value with more decimals than ``scale``
    raises; it is never rounded.  Without ``scale`` it is the plain AVG.
    """
    if scale is None:
        return lambda w: F.avg(col).over(w.rowsBetween(lo, hi))
    cs, cn = f"_cs_{col}_{-lo}_{-hi}", f"_cn_{col}_{-lo}_{-hi}"
    value = F.col(col).cast(f"decimal(18,{scale})")
    fits = value.cast("double").eqNullSafe(F.col(col).cast("double"))
    message = F.concat(F.lit(f"{col} has more than {scale} decimals: "), F.col(col).cast("string"))
    units = F.when(fits, (value * F.lit(10**scale)).cast("long")).otherwise(F.raise_error(message).cast("long"))
    helpers = {
        cs: lambda w: F.sum(units).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        cn: lambda w: F.count(col).over(w.rowsBetween(Window.unboundedPreceding, 0)),
    }

    def at(c: str, back: int, w: WindowSpec) -> Column:
        return F.col(c) if back == 0 else F.lag(c, back).over(w)

    def final(w: WindowSpec) -> Column:
        s = F.coalesce(at(cs, -hi, w), F.lit(0)) - F.coalesce(at(cs, 1 - lo, w), F.lit(0))
        n = F.coalesce(at(cn, -hi, w), F.lit(0)) - F.coalesce(at(cn, 1 - lo, w), F.lit(0))
        return F.when(n > 0, (s.cast("double") / F.lit(float(10**scale))) / n)

    return Staged(helpers, final)


def window_feature_exprs(
    include_current: bool = True, avg_scale: int | None = None
) -> tuple[dict[str, Callable[[WindowSpec], Column]], int]:
    """(name -> fn(window), reach in rows) for the lag/change/average features."""
    exprs: dict = {}
    reach = 0
    for name, col, k in LAG_FEATURES:
        exprs[name] = lambda w, c=col, k=k: F.lag(c, k).over(w)
        reach = max(reach, k)
    for name, col, k in CHANGE_FEATURES:
        exprs[name] = lambda w, c=col, k=k: F.col(c) - F.lag(c, k).over(w)
        reach = max(reach, k)
    for name, col, n in MOVING_AVG_FEATURES:
        lo, hi = (-(n - 1), 0) if include_current else (-n, -1)
        exprs[name] = moving_avg(col, lo, hi, avg_scale)
        reach = max(reach, 1 - lo)
    return exprs, reach


def default_tie_break(df: DataFrame, order: Sequence[str]) -> list[str]:
    """All other orderable columns, so ties on ``order`` resolve the same way every run."""
    skip = (T.MapType, T.ArrayType, T.StructType, T.BinaryType)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in order and not isinstance(f.dataType, skip) and not f.name.startswith("_")
    ]


#: Hours that ``densify_hours`` lists together.
_STRETCH = 1024


def densify_hours(df: DataFrame, ts: str = "ts", key: str | None = KEY, series_keys: Sequence[str] = ()) -> DataFrame:
    """Add a filler row (``_filler`` true, measures null) for every missing hour
    between each series' first and last hour, so row offsets equal hours.

    The grid of a series is built in two steps, first the starts of stretches of
    ``_STRETCH`` hours, then the hours of each, so no row ever holds the whole
    span (a mistyped far year would make a huge array), and anti-joined with
    the hours present.
    """
    bounds = df.where(F.col(ts).isNotNull()).groupBy(*series_keys).agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi")
    )
    stretches = bounds.select(
        *series_keys, "_hi", F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {_STRETCH} HOUR"))).alias("_from")
    )
    until = F.least("_hi", F.col("_from") + F.expr(f"INTERVAL {_STRETCH - 1} HOUR"))
    grid = stretches.select(
        *series_keys, F.explode(F.sequence(F.col("_from"), until, F.expr("INTERVAL 1 HOUR"))).alias(ts)
    )
    present = df.select(*series_keys, ts)
    missing = grid.join(present, [*series_keys, ts], "left_anti")
    if key and key in df.columns:
        from loadcast.functions.timekeys import format_key

        missing = missing.withColumn(key, format_key(ts))
    filler = missing.withColumn("_filler", F.lit(True))
    return df.withColumn("_filler", F.lit(False)).unionByName(filler, allowMissingColumns=True)


def window_features(
    df: DataFrame,
    order: Sequence[str] = ("ts",),
    tie_break: Sequence[str] | None = None,
    series_keys: Sequence[str] = (),
    include_current: bool = True,
    avg_scale: int | None = None,
    warmup_filter: bool = True,
    method: str = "halo",
    block: int = DEFAULT_BLOCK,
    keep_rn: bool = False,
    densify: bool = False,
) -> DataFrame:
    """LAG/change/moving-average features over the row order (counts rows, not hours).

    ``method="halo"`` numbers the rows once and evaluates the windows per
    block of ``block`` rows (parallel, no single-partition exchange);
    ``method="global"`` is the plain ``OVER (ORDER BY ...)`` form.
    With ``warmup_filter`` rows whose 7-day lag is null are dropped.
    With ``densify`` missing hours are filled first (and removed again after
    the windows), so lags and averages count hours instead of rows.
    """
    if densify:
        df = densify_hours(df, order[0], series_keys=series_keys)
    exprs, reach = window_feature_exprs(include_current, avg_scale)
    ties = list(default_tie_break(df, [*order, *series_keys]) if tie_break is None else tie_break)
    full_order = [*order, *ties]
    if method == "halo":
        seq, n = sized_sequence(df, full_order, series_keys=series_keys, rn_col="_rn")
        out = halo_windows(seq, exprs, reach=reach, block=block, series_keys=series_keys, rn_col="_rn", num_partitions=n)
        out = out.withColumnRenamed("_rn", "rn") if keep_rn else out.drop("_rn")
    elif method == "global":
        out = global_windows(df, exprs, full_order, series_keys)
    else:
        raise ValueError(f"unknown method {method!r}")
    if densify:
        out = out.where(~F.col("_filler")).drop("_filler")
    if warmup_filter:
        out = out.where(F.col(WARMUP_COLUMN).isNotNull())
    return out


def final_features(
    load: DataFrame,
    weather: DataFrame,
    ordered: bool = False,
    **window_opts,
) -> DataFrame:
    """join_raw -> window_features -> time_features and weather_features.

    Rows are numbered before the derived columns are there, so neither the
    numbering's sort key nor its written table carries them.

    The reference sorts its views by ts; sorting is only needed for display,
    so it is off unless ``ordered``.
    """
    series_keys = tuple(window_opts.get("series_keys", ()))
    joined = join_raw(load, weather, series_keys=series_keys)
    windowed = window_features(joined, **window_opts)
    derived = [*TIME_FEATURES, *WEATHER_FEATURES]
    feats = weather_features(time_features(windowed)).select(
        *joined.columns, *derived, *[c for c in windowed.columns if c not in joined.columns]
    )
    return feats.orderBy(*series_keys, "ts") if ordered else feats


def register_views(spark: SparkSession, load: DataFrame, weather: DataFrame, prefix: str = "", **window_opts) -> None:
    """Register the four chained feature views by name (session scoped).

    The last one numbers the rows, which runs the chain and writes a scratch
    table that lives as long as the session (or the open ``scratch_scope``).
    """
    joined = join_raw(load, weather)
    ft = time_features(joined)
    fw = weather_features(ft)
    ff = window_features(fw, **window_opts)
    for name, frame in (
        ("joined_raw", joined),
        ("features_time", ft),
        ("features_weather", fw),
        ("final_features", ff),
    ):
        frame.createOrReplaceTempView(prefix + name)


def lag_profile(
    df: DataFrame,
    value: str = "mw",
    order: Sequence[str] = ("ts", "event_id"),
    series_keys: Sequence[str] = (),
    lags: Sequence[int] = (1, 24, 168),
    ma_rows: int = 168,
    avg_scale: int | None = None,
    method: str = "halo",
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Generic per-row lags ``lag_<k>`` and trailing average ``ma_<n>`` of ``value``.

    Works on any ordered series, one or many (``series_keys``); a hot series
    is split into blocks like any other, so no task holds more than a block.
    """
    exprs: dict = {
        f"lag_{k}": (lambda w, k=k: F.lag(value, k).over(w)) for k in lags
    }
    if ma_rows:
        exprs[f"ma_{ma_rows}"] = moving_avg(value, -(ma_rows - 1), 0, avg_scale)
    reach = max([*lags, ma_rows if ma_rows else 0])
    if method == "global":
        return global_windows(df, exprs, list(order), series_keys)
    seq, n = sized_sequence(df, list(order), series_keys=series_keys, rn_col="_rn")
    out = halo_windows(seq, exprs, reach=reach, block=block, series_keys=series_keys, rn_col="_rn", num_partitions=n)
    return out.drop("_rn")
