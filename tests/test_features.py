"""Hand-written edge frames for the feature chain (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from loadcast.functions.timekeys import format_key
from loadcast.operators.features import densify_hours, final_features, join_raw, time_features, weather_features, window_features
from loadcast.schemas import LOAD, WEATHER


def _hours(n, start=dt.datetime(2024, 1, 1), skip=()):
    out, i, k = [], 0, 0
    while len(out) < n:
        t = start + dt.timedelta(hours=k)
        k += 1
        if k - 1 in skip:
            continue
        out.append(t.strftime("%Y-%m-%d %H:%M:%S"))
        i += 1
    return out


def test_null_weather_gives_zero_flags_and_null_square(spark):
    load = spark.createDataFrame([("2024-01-06 10:00:00", 5.0)], LOAD)
    weather = spark.createDataFrame([], WEATHER)
    row = weather_features(time_features(join_raw(load, weather))).first()
    assert row.TEMP is None and row.temp_squared is None and row.humidity_temp_interaction is None
    assert row.is_raining == 0
    assert row.is_weekend == 1  # 2024-01-06 is a Saturday
    assert row.day_of_week == 7 and row.hour_of_day == 10


def test_repeated_dst_hour_fans_out(spark):
    key = "2024-11-03 01:00:00"
    load = spark.createDataFrame([(key, 1.0), (key, 2.0)], LOAD)
    weather = spark.createDataFrame([(key, 1.0, 0.0, 1.0, 1.0, 1.0), (key, 2.0, 0.0, 1.0, 1.0, 1.0)], WEATHER)
    assert join_raw(load, weather).count() == 4


def test_ts_is_wall_clock_in_any_session_zone(spark):
    load = spark.createDataFrame([("2024-03-10 02:00:00", 1.0)], LOAD)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        j = join_raw(load, spark.createDataFrame([], WEATHER))
        row = j.select(F.hour("ts").alias("h"), format_key("ts").alias("k")).first()
        assert row.h == 2 and row.k == "2024-03-10 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bad_key_gives_null_ts_not_error(spark):
    load = spark.createDataFrame([("2024-02-30 01:00:00", 1.0), ("bad", 2.0)], LOAD)
    rows = join_raw(load, spark.createDataFrame([], WEATHER)).collect()
    assert [r.ts for r in rows] == [None, None]


def test_missing_hour_lag_counts_rows(spark):
    keys = _hours(30, skip={5})
    load = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], LOAD)
    feats = window_features(
        weather_features(time_features(join_raw(load, spark.createDataFrame([], WEATHER)))),
        warmup_filter=False,
    )
    by_key = {r.datetime_ept: r for r in feats.collect()}
    after_gap = by_key[keys[5]]  # the hour after the missing one
    assert after_gap.load_lag_1h == 4.0  # previous row, although it is 2 hours back
    assert by_key[keys[29]].load_lag_24h == 5.0


def test_warmup_170_rows_gives_2(spark):
    keys = _hours(170)
    load = spark.createDataFrame([(k, float(i % 13)) for i, k in enumerate(keys)], LOAD)
    weather = spark.createDataFrame([(k, 1.0, 0.0, 2.0, 3.0, 4.0) for k in keys], WEATHER)
    out = final_features(load, weather)
    assert out.count() == 2
    glob = final_features(load, weather, method="global")
    cols = sorted(out.columns)
    assert sorted(out.select(cols).collect()) == sorted(glob.select(cols).collect())


def test_moving_average_include_current_switch(spark):
    keys = _hours(200)
    load = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], LOAD)
    base = weather_features(time_features(join_raw(load, spark.createDataFrame([], WEATHER))))
    inc = {r.datetime_ept: r.load_ma_7d for r in window_features(base, warmup_filter=False).collect()}
    exc = {r.datetime_ept: r.load_ma_7d for r in window_features(base, warmup_filter=False, include_current=False).collect()}
    assert inc[keys[199]] == sum(range(32, 200)) / 168
    assert exc[keys[199]] == sum(range(31, 199)) / 168
    assert exc[keys[0]] is None


def test_feature_chain_names(spark):
    keys = _hours(170)
    load = spark.createDataFrame([(k, 1.0) for k in keys], LOAD)
    weather = spark.createDataFrame([(k, 1.0, 0.0, 2.0, 3.0, 4.0) for k in keys], WEATHER)
    cols = final_features(load, weather).columns
    assert cols[:8] == ["datetime_ept", "ts", "mw", "TEMP", "PRCP", "HMDT", "WND_SPD", "ATM_PRESS"]
    assert cols[-6:] == ["load_lag_1h", "load_lag_24h", "load_lag_7d", "temp_lag_2h", "temp_change_24h", "load_ma_7d"]


def test_densify_over_many_stretches(spark):
    """A span of several stretches, its last one cut short, and a series of one hour."""
    rows = [("a", "2021-01-01 05:00:00"), ("a", "2021-01-01 06:00:00"), ("a", "2021-06-30 17:00:00"), ("b", "2021-03-03 03:00:00")]
    df = spark.createDataFrame(rows, "s string, t string").select("s", F.col("t").cast("timestamp_ntz").alias("ts"))
    dense = densify_hours(df, key=None, series_keys=["s"])
    got = dense.groupBy("s").agg(F.count("*").alias("n"), F.count_distinct("ts").alias("d"), F.count_if("_filler").alias("f"), F.max("ts").alias("hi")).collect()
    hours = 180 * 24 + 13
    assert {r.s: (r.n, r.d, r.f, str(r.hi)) for r in got} == {
        "a": (hours, hours, hours - 3, "2021-06-30 17:00:00"), "b": (1, 1, 0, "2021-03-03 03:00:00")
    }


def test_densify_counts_hours(spark):
    keys = _hours(30, skip={5})
    load = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], LOAD)
    base = weather_features(time_features(join_raw(load, spark.createDataFrame([], WEATHER))))
    for method in ("halo", "global"):
        feats = window_features(base, warmup_filter=False, densify=True, method=method)
        by_key = {r.datetime_ept: r for r in feats.collect()}
        assert len(by_key) == 30 and "_filler" not in feats.columns
        assert by_key[keys[5]].load_lag_1h is None  # the missing hour, not the row before it
        assert by_key[keys[6]].load_lag_1h == 5.0
        assert by_key[keys[28]].load_lag_24h is None  # 24 hours back is the missing hour
        assert by_key[keys[29]].load_lag_24h == 5.0


def test_register_views_chain(spark):
    from loadcast.operators.features import register_views

    keys = _hours(170)
    load = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], LOAD)
    weather = spark.createDataFrame([(k, 1.0, 0.0, 2.0, 3.0, 4.0) for k in keys], WEATHER)
    register_views(spark, load, weather, prefix="t_")
    assert spark.sql("SELECT count(*) AS n FROM t_joined_raw").first().n == 170
    assert spark.sql("SELECT count(*) AS n FROM t_final_features").first().n == 2
    assert "is_weekend" in spark.table("t_features_time").columns


def test_series_keys_through_the_chain(spark):
    keys = _hours(200)
    rows = [(k, float(i % 17)) for i, k in enumerate(keys)]
    w_rows = [(k, float(i % 5), 0.1 * (i % 2), 2.0, 3.0, 4.0) for i, k in enumerate(keys)]
    load1 = spark.createDataFrame(rows, LOAD)
    weather1 = spark.createDataFrame(w_rows, WEATHER)
    single = {r.datetime_ept: r.asDict() for r in final_features(load1, weather1).collect()}
    load2 = spark.createDataFrame([(s, *r) for s in ("a", "b") for r in rows], "region string, datetime_ept string, mw double")
    weather2 = spark.createDataFrame(
        [(s, *r) for s in ("a", "b") for r in w_rows],
        "region string, datetime_ept string, TEMP double, PRCP double, HMDT double, WND_SPD double, ATM_PRESS double",
    )
    multi = final_features(load2, weather2, series_keys=("region",), block=170).collect()
    assert len(multi) == 2 * len(single)
    for r in multi:
        d = r.asDict()
        d.pop("region")
        assert d == single[d["datetime_ept"]]
