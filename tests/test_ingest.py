"""Cleaning and typed CSV/Parquet ingest: strict and quarantine modes."""

import logging
import os

import pytest

from loadcast.schemas import LOAD
from loadcast.sources import files as FI


def _csv(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write(text)
    return path


RAW = """YEAR,MO,DY,HR,TEMP,PRCP,HMDT,WND_SPD,ATM_PRESS,EXTRA
2021,4,1,0,10.5,0,80,3,1012,x
2021,4,1,1,11.0,0.2,81,4,1011,y
"""


def test_clean_weather_builds_key_and_ignores_extra(spark, scratch):
    p = _csv(scratch + "/ok", RAW)
    out = FI.clean_weather(FI.read_raw_weather_csv(spark, p), ordered=True)
    assert out.columns == ["datetime_ept", "TEMP", "PRCP", "HMDT", "WND_SPD", "ATM_PRESS"]
    rows = out.collect()
    assert str(rows[0].datetime_ept) == "2021-04-01 00:00:00" and rows[1].PRCP == 0.2


@pytest.mark.parametrize("bad", ["2021,2,30,1", "2021,4,1,24", "bad,4,1,1"])
def test_bad_date_strict_raises_quarantine_sets_aside(spark, scratch, bad):
    p = _csv(scratch + "/bad", RAW + bad + ",1,0,1,1,1,z\n")
    with pytest.raises(Exception):
        FI.clean_weather(FI.read_raw_weather_csv(spark, p)).collect()
    good, rejected = FI.clean_weather(FI.read_raw_weather_csv(spark, p), on_error="quarantine")
    assert good.count() == 2
    assert rejected.count() == 1


def test_missing_column_dropped_with_warning(spark, scratch, caplog):
    text = "YEAR,MO,DY,HR,TEMP,HMDT,WND_SPD,ATM_PRESS\n2021,4,1,0,10.5,80,3,1012\n"
    p = _csv(scratch + "/miss", text)
    with caplog.at_level(logging.WARNING):
        out = FI.clean_weather(FI.read_raw_weather_csv(spark, p))
    assert "PRCP" not in out.columns and out.count() == 1
    assert any("PRCP" in r.getMessage() for r in caplog.records)


def test_empty_or_bad_measure_strict_fails(spark, scratch):
    p = _csv(scratch + "/empty", "datetime_ept,mw\n2021-04-01 00:00:00,\n")
    with pytest.raises(Exception):
        FI.read_series_csv(spark, p, LOAD).collect()
    p2 = _csv(scratch + "/text", "datetime_ept,mw\n2021-04-01 00:00:00,abc\n")
    with pytest.raises(Exception):
        FI.read_series_csv(spark, p2, LOAD).collect()
    good, bad = FI.read_series_csv(spark, p2, LOAD, on_error="quarantine")
    assert good.count() == 0 and bad.count() == 1


def test_csv_parquet_roundtrip_counts(spark, scratch):
    p = _csv(scratch + "/load", "datetime_ept,mw\n\n2021-04-01 00:00:00,1.25\n2021-04-01 01:00:00,2.5\n")
    df = FI.read_series_csv(spark, p, LOAD)
    n = FI.write_series_parquet(df, scratch + "/pq")
    assert n == 2
    back = FI.external_table(spark, "t_roundtrip_load", scratch + "/pq", LOAD)
    assert sorted(r.mw for r in back.collect()) == [1.25, 2.5]
    with pytest.raises(Exception):
        FI.write_series_parquet(df, scratch + "/pq")  # exists: refuse, like the converter


def test_parts_are_not_truncated(spark, scratch):
    """A three-digit month is an error, never silently cut to two digits."""
    p = _csv(scratch + "/wide", "YEAR,MO,DY,HR,TEMP\n2021,123,1,1,1.0\n")
    with pytest.raises(Exception):
        FI.clean_weather(FI.read_raw_weather_csv(spark, p)).collect()
    good, bad = FI.clean_weather(FI.read_raw_weather_csv(spark, p), on_error="quarantine")
    assert good.count() == 0 and bad.count() == 1


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    """Any order, extra columns, quotes and a byte order mark; files that lack a column are listed, empty ones don't count."""
    texts = {
        "a.csv": "datetime_ept,mw\n2024-01-01 00:00:00,1.5\n",
        "b.csv": 'extra,"mw",datetime_ept\n"x, y",2.5,2024-01-01 01:00:00\nz,3.5,2024-01-01 02:00:00\n',
        "c.csv": "﻿mw,datetime_ept\n4.5,2024-01-01 03:00:00\n",
        "d.csv": "datetime_ept,load\n2024-01-01 04:00:00,9\n",
        "e.csv": "",
        "f.csv": "datetime_ept,mw\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows, aside = FI.read_by_own_headers(spark, str(tmp_path), ["datetime_ept", "mw"])
    assert sorted(map(tuple, rows.collect())) == [(f"2024-01-01 0{i}:00:00", f"{i + 1}.5") for i in range(4)]
    assert [(r.file.rsplit("/", 1)[1], r.missing) for r in aside.collect()] == [("d.csv", ["mw"])]
    typed = FI.typed_series(rows, LOAD)
    assert typed.agg({"mw": "sum"}).first()[0] == 12.0
