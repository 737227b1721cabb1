"""Structured Streaming ingest of JSON readings into the keyed log.

Source -> text -> ``from_json`` (permissive: garbage gives nulls, a wrong
typed field only nulls that field) -> key checks -> epoch of the key ->
``foreachBatch`` that writes the micro-batch from the executors as
``<log>/batch_id=N/dt=DAY`` (overwrite, so a replayed batch id replaces itself).
No row goes through the driver.

The fallback epoch for an unparsable key is the micro-batch's own timestamp
(``current_timestamp()`` in a streaming plan is fixed per batch and stored in
the offset log), so a replayed batch writes the same values.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadcast.functions.calendar import hour_floor
from loadcast.functions.timekeys import DEFAULT_ZONE, epoch_millis, format_key, parse_key
from loadcast.operators.compaction import is_folded
from loadcast.operators.kv import BATCH, DAY, kv_write_batch, with_day
from loadcast.streaming.control import BatchGate
from loadcast.schemas import KEY, LOAD_MESSAGE, STREAM_WEATHER_MEASURES, WEATHER_MESSAGE

log = logging.getLogger(__name__)


# ---------------------------------------------------------------- messages from the driver's events


def load_messages(events: DataFrame) -> DataFrame:
    """(value JSON text, seq) load readings; views carry no reading."""
    reading = F.when(F.col("event_type") == "view", F.lit(None).cast("double")).otherwise(F.col("value"))
    body = F.struct(format_key(hour_floor("ts")).alias("timestamp"), reading.alias("current_reading"))
    return events.select(F.to_json(body).alias("value"), F.col("event_id").alias("seq"))


def weather_messages(events: DataFrame) -> DataFrame:
    """(value JSON text, seq) weather readings derived from events."""
    body = F.struct(
        format_key(hour_floor("ts")).alias(KEY),
        F.col("value").alias("temp"),
        F.when(F.col("event_type") == "error", F.lit(0.5)).otherwise(F.lit(0.0)).alias("prcp"),
        F.col("user_id").cast("double").alias("hmdt"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("double")).otherwise(F.col("value")).alias("wnd_spd"),
        (F.lit(1000) + F.col("event_id") % 50).cast("double").alias("atm_press"),
    )
    return events.select(F.to_json(body).alias("value"), F.col("event_id").alias("seq"))


# ---------------------------------------------------------------- parsing


def parse_readings(
    messages: DataFrame,
    schema: T.StructType,
    key: str,
    zone: str = DEFAULT_ZONE,
    batch_time: Column | None = None,
    value_col: str = "value",
) -> DataFrame:
    """Decode JSON messages into typed columns plus ``key``, ``epoch_ms``, ``rejected``.

    Null keys are dropped (as the reference filters them); empty keys are kept
    but flagged ``rejected`` so they can be counted and left out of the log.
    """
    text = F.col(value_col).cast("string")
    parsed = messages.withColumn("_v", F.from_json(text, schema))
    fields = [F.col(f"_v.{f.name}").alias(f.name) for f in schema.fields]
    extra = [c for c in messages.columns if c != value_col]
    bt = F.current_timestamp() if batch_time is None else batch_time
    out = parsed.select(*fields, *extra).where(F.col(key).isNotNull())
    out = out.withColumn("key", F.col(key))
    fallback = F.unix_millis(bt)
    return out.withColumn("timestamp_ms", F.coalesce(epoch_millis(parse_key(key), zone), fallback)).withColumn(
        "rejected", F.col(key) == ""
    )


def load_cells() -> list[str]:
    return ["timestamp_ms", "current_reading"]


def weather_cells() -> list[str]:
    return list(STREAM_WEATHER_MEASURES)


# ---------------------------------------------------------------- the sink


def batch_writer(
    log_path: str,
    cells: Sequence[str],
    seq: str = "seq",
    reject_path: str | None = None,
    metrics_path: str | None = None,
):
    """foreachBatch callable: write accepted rows of the micro-batch into the log.

    The log is partitioned by the key's day below the batch.  A batch that a
    compaction has folded already (the last one, replayed) isn't written again.

    Rejected rows (empty key) are counted with ``observe``; with
    ``reject_path`` they are also written aside as ``<reject_path>/batch_id=N``.
    Then the batch (bounded by the trigger's offset cap) is persisted so both
    writes read one evaluation.  A failing write raises, the batch is not
    committed, and the stream retries it on restart.  With ``metrics_path``
    the batch's counts are kept as one row in ``<metrics_path>/batch_id=N``.
    """
    keep = ["key", seq, *cells]

    def write(batch: DataFrame, batch_id: int) -> None:
        src = batch.persist() if reject_path else batch
        try:
            if src.isEmpty():  # of the persisted batch, so that its input is read once
                log.info("batch %s is empty", batch_id)
                return
            obs = Observation(f"ingest_{batch_id}")
            observed = src.observe(
                obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("rejected")).alias("rejected")
            )
            accepted = with_day(observed.where(~F.col("rejected")).select(*keep))
            if is_folded(src.sparkSession, log_path, batch_id):
                accepted.write.format("noop").mode("overwrite").save()  # for the counts
            else:
                kv_write_batch(accepted, log_path, batch_id, partition_by=DAY)
            if reject_path:
                kv_write_batch(src.where(F.col("rejected")).drop("rejected"), reject_path, batch_id)
            m = obs.get
            log.info("batch %s: %s rows, %s rejected", batch_id, m.get("rows"), m.get("rejected"))
            if metrics_path:
                rows, rejected = int(m.get("rows", 0)), int(m.get("rejected", 0))
                one = src.sparkSession.createDataFrame(
                    [(rows, rejected, rows - rejected)], "rows long, rejected long, written long"
                )
                kv_write_batch(one, metrics_path, batch_id)
        finally:
            if reject_path:
                src.unpersist()

    return write


def start_ingest(
    parsed: DataFrame,
    log_path: str,
    checkpoint: str,
    cells: Sequence[str],
    trigger: dict | None = None,
    seq: str = "seq",
    reject_path: str | None = None,
    metrics_path: str | None = None,
    gate: BatchGate | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the stream: every trigger appends one batch folder to ``log_path``.

    ``trigger`` defaults to a 10-second processing-time trigger; tests pass
    ``{"availableNow": True}``.  With a ``gate`` the stream can be stopped between batches.
    """
    trig = {"processingTime": "10 seconds"} if trigger is None else trigger
    write = batch_writer(log_path, cells, seq, reject_path, metrics_path)
    stream = parsed.writeStream.foreachBatch(gate.wrap(write) if gate else write).outputMode("update").option("checkpointLocation", checkpoint)
    stream = stream.queryName(name) if name else stream
    return stream.trigger(**trig).start()


def start_current_view(
    parsed: DataFrame,
    out_path: str,
    checkpoint: str,
    cells: Sequence[str],
    trigger: dict | None = None,
    seq: str = "seq",
) -> StreamingQuery:
    """Stateful alternative to the raw log: keep the current row per key in state.

    A streaming aggregation (update mode) holds, per key, each cell's latest
    non-null value ordered by (batch time, ``seq``) -- last arrival wins, as
    in the log merge.  Each micro-batch writes only the keys it changed, as
    ``<out_path>/batch_id=N`` (overwrite: replay-safe); ``read_current_view``
    takes each key's row from its latest batch.  State is one row per key.
    """
    # The batch time is projected first: aggregates take only deterministic arguments.
    order = F.struct(F.col("_bt"), F.col(seq).alias("_seq"))
    accepted = parsed.where(~F.col("rejected")).withColumn("_bt", F.current_timestamp())
    current = accepted.groupBy("key").agg(
        F.max(order).alias("_ord"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cells],
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        kv_write_batch(batch.select("key", F.col("_ord._seq").alias(seq), *cells), out_path, batch_id)

    trig = {"processingTime": "10 seconds"} if trigger is None else trigger
    return (
        current.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trig)
        .start()
    )


def read_current_view(spark: SparkSession, out_path: str, cells: Sequence[str], seq: str = "seq") -> DataFrame:
    """Each key's row from the latest batch that changed it."""
    rows = spark.read.parquet(out_path)
    latest = F.max_by(F.struct(F.col(seq), *[F.col(c) for c in cells]), F.col(BATCH)).alias("_r")
    return rows.groupBy("key").agg(latest).select("key", F.col(f"_r.{seq}").alias(seq), *[F.col(f"_r.{c}").alias(c) for c in cells])


def run_for(query: StreamingQuery, timeout_s: float | None = None, continuous: bool = False, gate: BatchGate | None = None) -> None:
    """Wait until the stream has read all its input.

    With ``timeout_s`` a stream that isn't done by then is stopped (with its ``gate``, between
    batches) and TimeoutError raised: what it has written is only a part.  A ``continuous``
    stream has no end; stopping it after ``timeout_s`` is the normal case.
    """
    done = False
    try:
        done = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination() is None
    finally:
        if query.isActive and gate is not None:
            gate.stop(query)
        elif query.isActive:
            query.stop()
    if query.exception() is not None and gate is None:
        raise query.exception()
    if not done and not continuous:
        raise TimeoutError(f"the stream had not read all its input after {timeout_s} s")


def file_message_stream(spark: SparkSession, path_glob: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet file stream (stands in for a message bus in tests and replays)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path_glob)


def kafka_options(servers: str, topic: str, max_offsets: int | None = 100, starting: str = "latest") -> dict[str, str]:
    """Options of the Kafka source; without ``max_offsets`` a batch takes all there is."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    return options | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def kafka_message_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = 100, starting: str = "latest") -> DataFrame:
    """Kafka source with a per-trigger cap (needs the Kafka connector on the classpath)."""
    messages = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets, starting)).load()
    return messages.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))


LOAD_SCHEMA = LOAD_MESSAGE
WEATHER_SCHEMA = WEATHER_MESSAGE
