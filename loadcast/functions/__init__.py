"""Column expressions: calendar, weather, time keys and epochs, display text."""

from loadcast.functions.calendar import TIME_FEATURES, hour_floor
from loadcast.functions.display import time_of_day, two_dp
from loadcast.functions.timekeys import epoch_millis, epoch_seconds, format_key, parse_key, try_key_ts
from loadcast.functions.weather import FORECAST_WEATHER_DEFAULTS, WEATHER_FEATURES

__all__ = [
    "FORECAST_WEATHER_DEFAULTS", "TIME_FEATURES", "WEATHER_FEATURES", "epoch_millis", "epoch_seconds",
    "format_key", "hour_floor", "parse_key", "time_of_day", "try_key_ts", "two_dp",
]
