"""loadcast: hourly load forecasting analytics written as plain Spark jobs.

Layers:
  sources/    readers, writers, table adapters
  functions/  column expressions (calendar, weather, time keys, display)
  operators/  DataFrame operators (sequence numbering, halo windows,
              feature chain, time split, keyed-log merge)
  ml/         Spark ML training, scoring, persistence
  plans/      end-to-end jobs (batch entry points, forecast, export,
              serving queries) and the query catalogue with its DuckDB
              oracle SQL
  streaming/  Structured Streaming ingest into the keyed log
  session.py  session settings, the checkpoint-dir scratch area and its
              cleanup scope, partition sizing
  __main__.py command line
"""

__version__ = "0.1.0"
