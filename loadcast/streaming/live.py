"""Readings joined with the weather of their hour while both streams arrive.

Each side keeps one row an hour (the latest reading of each cell by sequence) until its
watermark passes the hour; then the hours meet in a left join, whose state is
given up by the same watermarks.  So state is bounded by the readings of the
``delay``, and the rows that come out are final: those of the batch join.
A reading that comes later than the delay is not in the result; Spark counts it
(``control.ProgressRows.late_rows``), and the keyed log still takes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadcast.functions.timekeys import parse_key
from loadcast.operators.kv import kv_write_batch


def hourly(parsed: DataFrame, cells: Sequence[str], delay: str = "2 hours", seq: str = "seq") -> DataFrame:
    """(key, hour, cells): one row per key, final once the watermark is past its hour.  Keys that aren't times are left out."""
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), parse_key("key"))
    at = F.timestamp_micros(since)  # the wall clock as if it were UTC: no zone moves it
    rows = parsed.where(~F.col("rejected")).withColumn("hour", at).where(F.col("hour").isNotNull()).withWatermark("hour", delay)
    # the width of a window in which a key stands alone: append mode emits it when the watermark passes its end
    window = F.window("hour", "1 hour")
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in cells]
    return rows.groupBy(window.alias("_w"), "key").agg(*latest)


def live_combined(load: DataFrame, weather: DataFrame, load_cells: Sequence[str], weather_cells: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """(key, load cells, weather cells): every hour of the load with its weather, null where there is none."""
    left = hourly(load, load_cells, delay)
    right = hourly(weather, weather_cells, delay).withColumnsRenamed({"key": "_key", "_w": "_v"})
    same = (F.col("key") == F.col("_key")) & (F.col("_w") == F.col("_v"))
    return left.join(right, same, "left").select("key", *load_cells, *weather_cells)


def start_live(joined: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Write the joined hours of every batch as ``<out>/batch_id=N``."""
    writer = joined.writeStream.outputMode("append").foreachBatch(lambda batch, i: kv_write_batch(batch, out_path, i)).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(**({"processingTime": "10 seconds"} if trigger is None else trigger)).start()
