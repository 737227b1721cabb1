"""Serving queries: range endpoints, the combined join, dashboard text."""

from pyspark.sql import functions as F

from loadcast.plans import serving as SV


def _kvs(spark):
    pred = spark.createDataFrame(
        [("2024-01-01 00:00:00", 10.0, 1), ("2024-01-01 01:00:00", 11.0, 2), ("2024-01-02 00:00:00", 12.0, 3)],
        "row_key string, prediction_value double, prediction_ts long",
    )
    load = spark.createDataFrame(
        [("2024-01-01 00:00:00", 1000, 10.0), ("2024-01-01 01:00:00", 2000, 11.0)],
        "key string, timestamp_ms long, current_reading double",
    )
    weather = spark.createDataFrame(
        [("2024-01-01 00:00:00", 5.0, 0.0, 0.0, 1.0, 1010.0)],
        "key string, temp double, prcp double, hmdt double, wnd_spd double, atm_press double",
    )
    return pred, load, weather


def test_endpoints_rename_and_scan(spark):
    pred, load, weather = _kvs(spark)
    p = SV.predictions(pred, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert p.columns == ["datetime", "timestamp", "predictedLoad"] and p.count() == 2
    a = SV.actual_load(load, "2024-01-01 00:00:00", "2024-01-01 01:00:00")
    assert a.columns == ["datetime", "timestamp", "actualLoad"] and a.count() == 1
    w = SV.weather(weather, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert w.columns == ["datetime", "temperature", "humidity", "pressure", "windSpeed", "precipitation"]


def test_text_cells_are_parsed(spark):
    kv = spark.createDataFrame([("2024-01-01 00:00:00", "12.5", "7")], "row_key string, prediction_value string, prediction_ts string")
    r = SV.predictions(kv, "2024-01-01", "2024-01-02").first()
    assert r.predictedLoad == 12.5 and r.timestamp == 7
    bad = spark.createDataFrame([("2024-01-01 00:00:00", "x", None)], "row_key string, prediction_value string, prediction_ts string")
    assert SV.predictions(bad, "2024-01-01", "2024-01-02").first().predictedLoad is None


def test_combined_keeps_predictions_without_actual(spark):
    pred, load, weather = _kvs(spark)
    rows = {r.datetime: r for r in SV.combined(pred, load, weather).collect()}
    assert len(rows) == 3
    assert rows["2024-01-02 00:00:00"].actual is None and rows["2024-01-02 00:00:00"].error is None
    assert rows["2024-01-01 00:00:00"].error == 0.0 and rows["2024-01-01 00:00:00"].temp == 5.0
    assert rows["2024-01-01 01:00:00"].temp is None
    day = SV.combined(pred, load, weather, date="2024-01-01")
    assert day.count() == 2


def test_dashboard_zero_and_null(spark):
    pred, load, weather = _kvs(spark)
    comb = SV.combined(pred, load, weather)
    rows = {r.datetime: r for r in SV.dashboard(comb).collect()}
    assert rows["2024-01-01 00:00:00"].error == "0.00" and rows["2024-01-01 00:00:00"].time == "00:00:00"
    assert rows["2024-01-02 00:00:00"].error == "N/A" and rows["2024-01-02 00:00:00"].actual == "N/A"
    js = {r.datetime: r for r in SV.dashboard(comb, zero_as_na=True).collect()}
    assert js["2024-01-01 00:00:00"].error == "N/A"
    assert js["2024-01-01 00:00:00"].predicted == "10.00"


def test_combined_filters_all_sides_before_join(spark):
    pred, load, weather = _kvs(spark)
    plan = SV.combined(pred, load, weather, date="2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("2024-01-01 23:59:59") >= 3
