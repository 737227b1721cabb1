"""The batch layer end to end: clean, convert, features, train, predict, export."""

import os

from conftest import SF01
from loadcast.plans import jobs as J
from loadcast.sources import adapters as AD
from loadcast.schemas import LOAD, WEATHER
from loadcast.sources import files as FI


def test_batch_layer_end_to_end(spark, scratch):
    ev = AD.read_table(spark, SF01, "events")
    load, weather = AD.load_series(ev), AD.weather_series(ev)

    raw_dir = scratch + "/raw"
    FI.write_series_csv(AD.raw_weather(weather), raw_dir, order=None)
    n_clean = J.clean_weather_file(spark, raw_dir, scratch + "/clean")
    assert n_clean == 678

    FI.write_series_csv(load, scratch + "/load_csv")
    FI.write_series_csv(weather, scratch + "/weather_csv")
    n_load, n_weather = J.csv_to_parquet(
        spark, scratch + "/load_csv", scratch + "/weather_csv", scratch + "/load_pq", scratch + "/weather_pq"
    )
    assert (n_load, n_weather) == (720, 678)

    load_t = FI.external_table(spark, "t_jobs_load", scratch + "/load_pq", LOAD)
    weather_t = FI.external_table(spark, "t_jobs_weather", scratch + "/weather_pq", WEATHER)
    feats = J.build_training_table(load_t, weather_t, "t_jobs_training", scratch + "/training")
    assert feats.count() == 552

    res = J.run_model_training(feats, scratch + "/model", grid={"numTrees": [10], "maxDepth": [5]}, folds=2)
    assert res.n_features == 19 and res.rmse > 0 and res.bounds.first().ordered

    preds = J.run_prediction(spark, scratch + "/model", load_t, weather_t, scratch + "/preds", run_id="r1")
    assert preds.count() == 24
    J.run_prediction(spark, scratch + "/model", load_t, weather_t, scratch + "/preds", run_id="r2")
    out = J.export_predictions(spark.read.parquet(scratch + "/preds"))
    assert out.count() == 24 and out.select("row_key").distinct().count() == 24

    assert J.run_prediction(spark, scratch + "/no-model", load_t, weather_t) is None
    assert not os.path.exists(scratch + "/no-model")


def test_clean_weather_file_quarantine(spark, scratch):
    raw = scratch + "/raw"
    os.makedirs(raw)
    with open(raw + "/part.csv", "w") as f:
        f.write("YEAR,MO,DY,HR,TEMP,PRCP,HMDT,WND_SPD,ATM_PRESS\n2021,4,1,0,1,0,1,1,1\n2021,2,30,1,1,0,1,1,1\n")
    assert J.clean_weather_file(spark, raw, scratch + "/clean", on_error="quarantine") == 1
    assert spark.read.option("header", True).csv(scratch + "/clean_rejected").count() == 1
    import pytest

    with pytest.raises(Exception):
        J.clean_weather_file(spark, raw, scratch + "/strict")
    assert not os.path.exists(scratch + "/strict/_SUCCESS")  # all or nothing
