"""Declared schemas of every dataset (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "datetime_ept"

# Weather measures in batch files and tables (upper case, as the batch layer names them).
WEATHER_MEASURES = ["TEMP", "PRCP", "HMDT", "WND_SPD", "ATM_PRESS"]
# Weather measures in stream messages (lower case, as the speed layer names them).
STREAM_WEATHER_MEASURES = ["temp", "prcp", "hmdt", "wnd_spd", "atm_press"]

LOAD = T.StructType(
    [
        T.StructField(KEY, T.StringType(), True),
        T.StructField("mw", T.DoubleType(), True),
    ]
)

WEATHER = T.StructType(
    [T.StructField(KEY, T.StringType(), True)]
    + [T.StructField(m, T.DoubleType(), True) for m in WEATHER_MEASURES]
)

# Speed-layer messages (JSON).
LOAD_MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("current_reading", T.DoubleType(), True),
    ]
)

WEATHER_MESSAGE = T.StructType(
    [T.StructField(KEY, T.StringType(), True)]
    + [T.StructField(m, T.DoubleType(), True) for m in STREAM_WEATHER_MEASURES]
)

# Columns that never enter the feature vector.
NON_FEATURES = ("mw", "ts", KEY)
