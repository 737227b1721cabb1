"""The command line drives the same jobs (in-process, sharing the test session)."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF01
from loadcast.__main__ import main
from loadcast.sources import adapters as AD
from loadcast.sources import files as FI


def test_cli_batch_stream_and_serving(spark, scratch, capsys):
    ev = AD.read_table(spark, SF01, "events")
    load, weather = AD.load_series(ev), AD.weather_series(ev)
    FI.write_series_csv(load, scratch + "/load_csv")
    FI.write_series_csv(weather, scratch + "/weather_csv")
    s = scratch
    assert main(["csv-to-parquet", s + "/load_csv", s + "/weather_csv", s + "/load_pq", s + "/weather_pq"], spark) == 0
    assert main(["features", s + "/load_pq", s + "/weather_pq", "t_cli_features", s + "/features"], spark) == 0
    assert main(["train", s + "/features", s + "/model", "--grid", "quick", "--folds", "2"], spark) == 0
    assert main(["predict", s + "/model", s + "/load_pq", s + "/weather_pq", s + "/preds", "--run-id", "r1"], spark) == 0
    assert main(["export", s + "/preds", s + "/pred_kv", "--batch-id", "1"], spark) == 0
    out = capsys.readouterr().out
    assert "load rows: 720, weather rows: 678" in out and "feature rows: 552" in out and "test RMSE" in out

    src = s + "/msgs"
    os.makedirs(src)
    day = str(spark.read.parquet(s + "/pred_kv").agg({"dt": "min"}).first()[0])
    msgs = [(json.dumps({"timestamp": f"{day} {h:02d}:00:00", "current_reading": 100.0 + h}), h) for h in range(24)]
    pq.write_table(pa.table({"value": [m for m, _ in msgs], "seq": [q for _, q in msgs]}), src + "/a.parquet")
    assert main(["ingest", "load", src, s + "/load_log", s + "/ckpt_l", "--available-now", "--metrics-path", s + "/m"], spark) == 0
    assert spark.read.parquet(s + "/m").first().written == 24
    wmsgs = [json.dumps({"datetime_ept": f"{day} {h:02d}:00:00", "temp": 1.5, "hmdt": 40.0}) for h in range(24)]
    os.makedirs(s + "/wsrc")
    pq.write_table(pa.table({"value": wmsgs, "seq": list(range(24))}), s + "/wsrc/w.parquet")
    assert main(["ingest", "weather", s + "/wsrc", s + "/weather_log", s + "/ckpt_w", "--available-now"], spark) == 0
    capsys.readouterr()
    assert main(["combined", day, s + "/pred_kv", s + "/load_log", s + "/weather_log", "--dashboard"], spark) == 0
    table = capsys.readouterr().out
    assert "N/A" not in table.split("\n", 3)[3] and "1.50" in table

    # the same through the stateful speed layer
    assert main(["ingest", "load", src, s + "/load_view", s + "/ckpt_lv", "--available-now", "--stateful"], spark) == 0
    assert main(["ingest", "weather", s + "/wsrc", s + "/weather_view", s + "/ckpt_wv", "--available-now", "--stateful"], spark) == 0
    capsys.readouterr()
    assert main(["combined", day, s + "/pred_kv", s + "/load_view", s + "/weather_view", "--dashboard", "--views"], spark) == 0
    assert capsys.readouterr().out == table


def test_cli_export_is_an_upsert(spark, scratch):
    import datetime as dt

    from pyspark.sql import functions as F

    from loadcast.operators import kv as KV

    base = dt.datetime(2024, 3, 1)
    rows = lambda start, value: [
        ((base + dt.timedelta(hours=start + h)).strftime("%Y-%m-%d %H:%M:%S"), value) for h in range(24)
    ]
    schema = "t string, predicted_load_mw double"
    for run, start, value in (("r1", 0, 1.0), ("r2", 12, 2.0)):
        df = spark.createDataFrame(rows(start, value), schema).select(
            F.col("t").cast("timestamp_ntz").alias("ts"), "predicted_load_mw", F.lit(run).alias("run_id")
        )
        df.write.mode("overwrite").parquet(f"{scratch}/p_{run}")
        assert main(["export", f"{scratch}/p_{run}", scratch + "/kv", "--batch-id", run[1]], spark) == 0
    log = spark.read.parquet(scratch + "/kv")
    cur = {r.row_key: r.prediction_value for r in KV.kv_current(log, "row_key", ("batch_id",), ["prediction_value"]).collect()}
    assert len(cur) == 36  # the first export's early hours survive the second export
    assert cur["2024-03-01 00:00:00"] == 1.0 and cur["2024-03-01 12:00:00"] == 2.0


def test_ingest_options_reach_the_sources(spark, monkeypatch, scratch):
    """The cap and the starting offsets are passed on; 0 means no cap."""
    from loadcast.__main__ import main
    from loadcast.streaming import ingest as IN

    seen = []
    monkeypatch.setattr(IN, "kafka_message_stream", lambda *a: seen.append(a[1:]) or (_ for _ in ()).throw(KeyError))
    monkeypatch.setattr(IN, "file_message_stream", lambda *a: seen.append(a[1:]) or (_ for _ in ()).throw(KeyError))
    tail = ["load", scratch, scratch + "/log", scratch + "/ckpt"]
    for extra in (["--kafka", "h:1", "--topic", "t", "--max-per-trigger", "5000", "--starting-offsets", "earliest"], ["--max-per-trigger", "0"], []):
        with pytest.raises(KeyError):
            main(["ingest", *tail, *extra], spark)
    assert seen == [("h:1", "t", 5000, "earliest"), (scratch, "value string, seq long", None), (scratch, "value string, seq long", 100)]
    assert IN.kafka_options("h:1", "t", None)["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in IN.kafka_options("h:1", "t", None)
    assert IN.kafka_options("h:1", "t", 7, "earliest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "7",
    }


def test_compact_command(spark, scratch, capsys):
    from loadcast.__main__ import main
    from loadcast.operators import kv as KV

    log = scratch + "/log"
    for b in range(2):
        one = spark.createDataFrame([("2024-01-01 00:00:00", b, 1, float(b))], "key string, seq long, timestamp_ms long, current_reading double")
        KV.kv_write_batch(KV.with_day(one), log, b, partition_by=KV.DAY)
    assert main(["compact", "load", log, "--grace", "0"], spark) == 0
    assert "manifest version 2: 1 days, through batch 1" in capsys.readouterr().out
    from loadcast.plans.jobs import current_table

    assert current_table(spark, "load", log).first().current_reading == 1.0
