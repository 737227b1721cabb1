"""Appended slices equal one full run; reruns, late rows, what is read; buckets; far forecasts."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from loadcast.operators import appending as AP
from loadcast.operators import bucketed as BU
from loadcast.operators import features as FE
from loadcast.plans import forecast as FC
from loadcast.plans import serving as SV

SCHEMA = "user_id int, datetime_ept string, ts timestamp_ntz, mw double, TEMP double, PRCP double, HMDT double, WND_SPD double, ATM_PRESS double"
START = dt.datetime(2024, 1, 1)


def hourly(series, first, last, rnd):
    for i in range(first, last):
        ts = START + dt.timedelta(hours=i)
        value = None if rnd.random() < 0.05 else round(rnd.random() * 100, 2)
        yield (series, ts.strftime("%Y-%m-%d %H:%M:%S"), ts, value, round(rnd.random() * 9, 1), 0.5, 1.0, 2.0, 3.0)


def as_set(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_slices_equal_the_full_run(spark, scratch):
    """Three series, one that begins late and one that stops; slices from one hour to more than a week; a null series."""
    rnd, cuts = random.Random(4), [0, 1, 30, 31, 220, 240, 400]
    rows = [*hourly(1, 0, 400, rnd), *hourly(2, 230, 400, rnd), *hourly(None, 0, 60, rnd)]
    whole = spark.createDataFrame(rows, SCHEMA).cache()
    hour = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts"))
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = whole.where(hour.between(a, b - 1))
        for _ in range(1 + (i == 3)):  # one slice twice: it replaces itself
            AP.append_features(part, scratch + "/out", scratch + "/state", i, series_keys=("user_id",), avg_scale=2)
    full = FE.weather_features(FE.time_features(FE.window_features(whole, series_keys=("user_id",), avg_scale=2, warmup_filter=False)))
    got = spark.read.parquet(scratch + "/out").select(*full.columns)
    assert as_set(got) == as_set(full)
    assert AP._state_slices(spark, scratch + "/state") == [4, 5]  # older states are gone
    state = spark.read.parquet(scratch + "/state/slice=5")
    assert {tuple(r) for r in state.groupBy("user_id").count().collect()} == {(1, 168), (2, 168), (None, 60)}


def test_only_the_latest_state_is_read(spark, scratch):
    whole = spark.createDataFrame(list(hourly(1, 0, 300, random.Random(1))), SCHEMA)
    tail = None
    for a, b in ((0, 200), (200, 300)):
        part = whole.where((F.col("ts") >= START + dt.timedelta(hours=a)) & (F.col("ts") < START + dt.timedelta(hours=b)))
        feats, kept = AP.window_slice(part, tail, avg_scale=2)
        kept.write.parquet(f"{scratch}/tail{a}")
        tail = spark.read.parquet(f"{scratch}/tail{a}")
    assert feats.count() == 100 and tail.count() == 168 and feats.where("load_lag_7d is null").count() < 20


def test_a_row_before_its_series_state_raises(spark, scratch):
    rows = list(hourly(1, 10, 20, random.Random(1)))
    AP.append_features(spark.createDataFrame(rows, SCHEMA), scratch + "/out", scratch + "/state", 0, series_keys=("user_id",))
    late = spark.createDataFrame(list(hourly(1, 5, 25, random.Random(2))), SCHEMA)
    with pytest.raises(ValueError, match="before the last known"):
        AP.append_features(late, scratch + "/out", scratch + "/state", 1, series_keys=("user_id",))
    other = spark.createDataFrame(list(hourly(2, 5, 8, random.Random(2))), SCHEMA)  # another series may begin earlier
    AP.append_features(other, scratch + "/out", scratch + "/state", 1, series_keys=("user_id",))
    AP.append_features(other.where("false"), scratch + "/out", scratch + "/state", 2, series_keys=("user_id",))
    assert spark.read.parquet(scratch + "/out").count() == 13 and spark.read.parquet(scratch + "/state/slice=2").count() == 13


def test_a_slice_numbers_only_its_own_rows(spark, scratch, monkeypatch):
    """The state isn't sorted and written again for each slice; it is where times meet, or where an older state has no places."""
    whole = spark.createDataFrame([r for s in (1, 2, None) for r in hourly(s, 0, 300, random.Random(7))], SCHEMA).cache()
    numbered = []
    monkeypatch.setattr(AP, "sized_sequence", lambda df, *a, f=AP.sized_sequence, **b: numbered.append(df.count()) or f(df, *a, **b))
    hour = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts"))
    parts = [(hour < 200), (hour >= 200) & (hour < 210), (hour >= 210)]
    full = FE.weather_features(FE.time_features(FE.window_features(whole, series_keys=("user_id",), avg_scale=2, warmup_filter=False)))
    for label in ("placed", "older"):
        out, state = f"{scratch}/{label}-out", f"{scratch}/{label}-state"
        for i, part in enumerate(parts):
            if label == "older" and i == 2:
                spark.read.parquet(f"{state}/slice=1").select(*whole.columns).write.parquet(f"{state}/slice=1b")
                bare = spark.read.parquet(f"{state}/slice=1b").localCheckpoint()
                bare.write.mode("overwrite").parquet(f"{state}/slice=1")
            AP.append_features(whole.where(part), out, state, i, series_keys=("user_id",), avg_scale=2)
        assert as_set(spark.read.parquet(out).select(*full.columns)) == as_set(full)
        last = spark.read.parquet(f"{state}/slice=2")
        assert sorted(r["_back"] for r in last.where("user_id = 1").collect()) == list(range(1, 169))
    assert numbered == [600, 30, 270, 600, 30, 270 + 3 * 168]


def test_rows_beside_the_last_known_one(spark, scratch):
    """A slice may begin at the time its series' state ends: the state's rows come first, and go by all columns later."""
    rows = sorted(hourly(1, 0, 60, random.Random(3)), key=lambda r: r[2])
    first, second, third = rows[:20] + [(*rows[19][:3], 0.5, *rows[19][4:])], [(*rows[19][:3], 0.25, *rows[19][4:]), *rows[20:40]], rows[40:]
    for i, part in enumerate((first, second, third)):
        AP.append_features(spark.createDataFrame(part, SCHEMA), scratch + "/out", scratch + "/state", i, series_keys=("user_id",), avg_scale=2)
    got = spark.read.parquet(scratch + "/out")
    assert got.count() == 62 and spark.read.parquet(scratch + "/state/slice=2").count() == 62
    lag = {r.ts: r.load_lag_24h for r in got.collect()}
    assert lag[third[0][2]] == rows[18][3]


# ---------------------------------------------------------------- buckets


def test_buckets_join_without_a_shuffle(spark, scratch):
    keys = spark.range(500).select(F.format_string("2024-01-01 %05d", "id").alias("key"), F.col("id").cast("double").alias("v"))
    pred = BU.write_buckets(keys.select(F.col("key").alias("row_key"), (F.col("v") + 1).alias("prediction_value")), "b_pred", scratch + "/p", 4, "row_key")
    load = BU.write_buckets(keys.where("v % 2 = 0").select("key", F.col("v").alias("current_reading")), "b_load", scratch + "/l", 4)
    weather = BU.write_buckets(keys.where("v % 3 = 0").select("key", *[F.col("v").alias(c) for c in ("temp", "hmdt", "wnd_spd")]), "b_weather", scratch + "/w", 4)
    try:
        plain = as_set(SV.combined(pred, load, weather))
        for sorted_buckets in ("false", "true"):
            spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", sorted_buckets)
            comb = SV.combined(pred, load, weather, join="merge")
            plan = comb._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
            assert ("Sort [" in plan) == (sorted_buckets == "false")
            assert as_set(comb) == plain and comb.count() == 500
        day = SV.combined(pred, load, weather, start="2024-01-01 00100", stop="2024-01-01 00200", join="merge")
        assert day.count() == 100 and "Exchange" not in day._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
        for t in ("b_pred", "b_load", "b_weather"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


# ---------------------------------------------------------------- far forecasts


def history(hours, rnd):
    return [(*r[1:],) for r in hourly(1, 0, hours, rnd)]


@pytest.mark.parametrize("ahead", [0, 30, 200, 24 * 20])
def test_lags_step_back_to_the_latest_known_hour(spark, ahead):
    """Against the definition: of the hours a whole number of days (weeks) before, the latest known within reach."""
    rows = history(24 * 40, random.Random(ahead))
    joined = spark.createDataFrame(rows, SCHEMA.split(", ", 1)[1])
    start = START + dt.timedelta(hours=24 * 40 + ahead)
    got = FC.forecast_inputs(joined, start=start, avg_scale=2).collect()
    load = {r[1]: r[2] for r in rows}
    days, weeks = -(-(ahead + 24) // 24), -(-(ahead + 24) // 168)

    def back(ts, first, step, times):
        known = (load.get(ts - dt.timedelta(hours=first + step * j)) for j in range(times))
        return next((v for v in known if v is not None), None)

    assert len(got) == 24
    for r in got:
        assert r["load_lag_1h"] == back(r["ts"], 1, 24, days + 1)
        assert r["load_lag_24h"] == back(r["ts"], 24, 24, days)
        assert r["load_lag_7d"] == back(r["ts"], 168, 168, weeks)


def test_a_year_ahead_is_planned_quickly(spark):
    """The plan doesn't grow with the horizon."""
    joined = spark.createDataFrame(history(24 * 30, random.Random(1)), SCHEMA.split(", ", 1)[1]).cache()
    FC.forecast_inputs(joined, start=START + dt.timedelta(days=40)).collect()
    began = time.time()
    far = FC.forecast_inputs(joined, start=START + dt.timedelta(days=30 + 365))
    far._jdf.queryExecution().executedPlan()
    assert time.time() - began < 5
    rows = far.collect()
    assert len(rows) == 24 and all(r["load_lag_1h"] is not None or r["ts"].hour >= 0 for r in rows)
    assert far._jdf.queryExecution().optimizedPlan().toString().count("Window [") < 12
