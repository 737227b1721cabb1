"""Readers, writers and table adapters."""

from loadcast.sources.adapters import event_series, keyed_upserts, load_series, raw_weather, read_table, weather_series
from loadcast.sources.files import (
    clean_weather,
    external_table,
    read_raw_weather_csv,
    read_series_csv,
    training_table,
    write_series_csv,
    write_series_parquet,
)

__all__ = [
    "clean_weather", "event_series", "external_table", "keyed_upserts", "load_series", "raw_weather",
    "read_raw_weather_csv", "read_series_csv", "read_table", "training_table", "weather_series",
    "write_series_csv", "write_series_parquet",
]
