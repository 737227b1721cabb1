"""Weather-derived features and forecast-time defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def temp_squared(temp: str = "TEMP") -> Column:
    # A product, not POWER(x, 2): the same value, and bit-stable across engines.
    return F.col(temp) * F.col(temp)


def is_raining(prcp: str = "PRCP") -> Column:
    """1 when precipitation > 0, else 0 (a null reading gives 0)."""
    return F.when(F.col(prcp) > 0, F.lit(1)).otherwise(F.lit(0))


def humidity_temp_interaction(hmdt: str = "HMDT", temp: str = "TEMP") -> Column:
    return F.col(hmdt) * F.col(temp)


WEATHER_FEATURES = {
    "temp_squared": temp_squared,
    "is_raining": is_raining,
    "humidity_temp_interaction": humidity_temp_interaction,
}

# Defaults the forecast uses for weather it does not know.
FORECAST_WEATHER_DEFAULTS = {"PRCP": 0.0, "HMDT": 50.0, "WND_SPD": 10.0, "ATM_PRESS": 1013.0}
