"""The current row per key in streaming state that expires.

Like ``ingest.start_current_view`` this combines the readings of a key before
anything is written, but a key's state goes ``ttl_s`` seconds after its last
reading, so the state holds the keys that are being written to and not all there
ever were.  Each batch writes the keys it changed, one row each, with the cells
known so far; a key whose state is gone begins anew with the cells that come.  The
table is the merge of these rows, each cell's latest that isn't null, so it equals
the merge of all readings whenever a state expired, also for late or replayed ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from loadcast.operators.kv import BATCH, DAY, kv_current, kv_read_log, kv_write_batch, with_day

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestCells(StatefulProcessor):
    """Per key: each cell's latest non-null value by (batch, sequence), and the sequence of the latest reading."""

    def __init__(self, cells: Sequence[str], state: T.StructType, ttl_ms: int):
        self._cells, self._schema, self._ttl = list(cells), state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._latest = handle.getValueState("latest", self._schema, self._ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        known = self._latest.get()
        cells = dict(zip(self._cells, known[1:], strict=True)) if known else dict.fromkeys(self._cells)
        # what the state holds came in an earlier batch, so it's older than all of this one
        best, seq = dict.fromkeys(self._cells), None
        for part in rows:
            part = part.sort_values("seq", kind="stable", na_position="first")
            last = part["seq"].iloc[-1]
            if not pd.isna(last) and (seq is None or last > seq):
                seq = int(last)
            for c in self._cells:
                some = part[part[c].notna()]
                if len(some):
                    place = some["seq"].iloc[-1]
                    place = float("-inf") if pd.isna(place) else place
                    if best[c] is None or place >= best[c][0]:
                        best[c] = (place, some[c].iloc[-1].item())
        for c, found in best.items():
            if found is not None:
                cells[c] = found[1]
        self._latest.update((seq, *cells.values()))
        yield pd.DataFrame({"key": [key[0]], "seq": pd.array([seq], dtype="Int64"), **{c: [v] for c, v in cells.items()}})

    def close(self) -> None:
        pass


def start_expiring_view(
    parsed: DataFrame, out_path: str, checkpoint: str, cells: Sequence[str], ttl_s: float, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Start the stream; every batch writes the keys it changed as ``<out>/batch_id=N/dt=DAY``.

    State that can expire needs the RocksDB state store; the session's other streams keep their own.
    """
    spark = parsed.sparkSession
    kinds = {f.name: f.dataType for f in parsed.schema.fields}
    state = T.StructType([T.StructField("seq", T.LongType()), *(T.StructField(c, kinds[c]) for c in cells)])
    out = T.StructType([T.StructField("key", T.StringType()), *state.fields])
    readings = parsed.where(~F.col("rejected")).select("key", F.col("seq").cast("long").alias("seq"), *cells)
    current = readings.groupBy("key").transformWithStateInPandas(
        statefulProcessor=LatestCells(cells, state, max(1, int(ttl_s * 1000))), outputStructType=out, outputMode="Update", timeMode="ProcessingTime"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        kv_write_batch(with_day(batch), out_path, batch_id, partition_by=DAY)

    # Without batches that have no data: a processing-time state would have them for ever.  What has expired
    # is not seen any more, and is removed with the next batch.
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        writer = current.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        writer = writer.queryName(name) if name else writer
        return writer.trigger(**({"processingTime": "10 seconds"} if trigger is None else trigger)).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def read_expiring_view(spark: SparkSession, out_path: str, cells: Sequence[str]) -> DataFrame:
    """The current table (key, day, seq, cells)."""
    return kv_current(kv_read_log(spark, out_path), "key", (BATCH, "seq"), cells, day=DAY)
