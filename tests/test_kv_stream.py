"""Keyed log merge, stream parsing edge cases, replay and restart."""

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loadcast.functions.timekeys import epoch_seconds
from loadcast.operators import kv as KV
from loadcast.plans import catalogue as CA
from loadcast.streaming import ingest as IN


def _msgs(spark, items):
    return spark.createDataFrame([(v, i) for i, v in enumerate(items)], "value string, seq long")


def test_json_edge_cases(spark):
    items = [
        "garbage",
        None,
        '{"current_reading": 2}',
        '{"timestamp": "", "current_reading": 2}',
        '{"timestamp": "2024-01-01 05:00:00", "current_reading": "x"}',
        '{"timestamp": 5, "current_reading": 2}',
        '{"timestamp": "2024-01-01 05:00:00", "current_reading": 7.5}',
    ]
    batch_time = F.lit("2030-01-01 00:00:00").cast("timestamp")
    out = IN.parse_readings(_msgs(spark, items), IN.LOAD_SCHEMA, "timestamp", batch_time=batch_time)
    rows = {r.seq: r for r in out.collect()}
    assert set(rows) == {3, 4, 5, 6}  # garbage / null / missing key filtered
    assert rows[3].rejected is True  # empty key
    assert rows[4].current_reading is None and rows[4].rejected is False  # wrong type -> null field
    assert rows[5].key == "5"  # numeric key as text
    assert rows[5].timestamp_ms == 1893456000000  # unparsable -> batch time
    assert rows[6].timestamp_ms == 1704103200000  # 05:00 New York = 10:00 UTC


def test_kv_current_null_cell_survives_and_later_wins(spark):
    log = spark.createDataFrame(
        [("k", 0, 1, 1.0, "a"), ("k", 1, 2, None, "b"), ("j", 0, 3, 3.0, None)],
        "key string, batch_id int, seq long, v double, p string",
    )
    cur = {r.key: r for r in KV.kv_current(log, "key", ("batch_id", "seq"), ["v", "p"]).collect()}
    assert cur["k"].v == 1.0 and cur["k"].p == "b" and cur["k"].seq == 2
    assert cur["j"].p is None


def test_batch_replay_is_idempotent(spark, scratch):
    log_path = scratch + "/log"
    b0 = spark.createDataFrame([("k", 1, 1.0)], "key string, seq long, v double")
    b1 = spark.createDataFrame([("k", 2, 2.0)], "key string, seq long, v double")
    KV.kv_write_batch(b0, log_path, 0)
    KV.kv_write_batch(b1, log_path, 1)
    first = KV.kv_current(KV.kv_read_log(spark, log_path), "key", ("batch_id", "seq"), ["v"]).collect()
    KV.kv_write_batch(b0, log_path, 0)  # replay
    again = KV.kv_current(KV.kv_read_log(spark, log_path), "key", ("batch_id", "seq"), ["v"]).collect()
    assert first == again and first[0].v == 2.0
    assert KV.kv_read_log(spark, log_path).count() == 2


def test_compact_then_merge(spark, scratch):
    log_path = scratch + "/log"
    KV.kv_write_batch(spark.createDataFrame([("k", 1, 1.0, "a")], "key string, seq long, v double, p string"), log_path, 0)
    KV.kv_write_batch(spark.createDataFrame([("k", 2, None, "b")], "key string, seq long, v double, p string"), log_path, 1)
    snap = KV.kv_compact(spark, log_path, scratch + "/snap", "key", ("batch_id", "seq"), ["v", "p"]).first()
    assert snap.v == 1.0 and snap.p == "b" and snap.batch_id == 1


def test_kv_cells_drop_nulls(spark):
    df = spark.createDataFrame([("k", 1, None, "x"), ("j", 2, 2.5, None)], "key string, seq long, v double, p string")
    cells = sorted(tuple(r) for r in KV.kv_cells(df, "key", "seq", ["v", "p"]).collect())
    assert cells == [("j", 2, "v", "2.5"), ("k", 1, "p", "x")]


def test_range_scan_bounds(spark):
    kv = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 05:00:00",), ("2024-01-02 00:00:00",)], "key string")
    got = [r.key for r in KV.range_scan(kv, "2024-01-01 00:00:00", "2024-01-02 00:00:00").collect()]
    assert sorted(got) == ["2024-01-01 00:00:00", "2024-01-01 05:00:00"]


def test_export_latest_dedup(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [
        ((base + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S"), float(h), run)
        for h in range(30)
        for run in ("r1", "r2")
    ]
    preds = spark.createDataFrame(rows, "t string, predicted_load_mw double, run_id string").select(
        F.col("t").cast("timestamp_ntz").alias("ts"), "predicted_load_mw", "run_id"
    )
    assert KV.export_latest(preds, n=24).select("row_key").distinct().count() == 24


def test_epoch_zone_winter_offset(spark):
    df = spark.createDataFrame([("2024-01-15 12:00:00",)], "k string").select(F.col("k").cast("timestamp_ntz").alias("t"))
    ny = df.select(epoch_seconds("t", "America/New_York").alias("e")).first().e
    utc = df.select(epoch_seconds("t", "UTC").alias("e")).first().e
    assert ny - utc == 5 * 3600
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert df.select(epoch_seconds("t", "America/New_York").alias("e")).first().e == ny
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _write_events(path, rows):
    table = pa.table(
        {
            "value": pa.array([json.dumps(r[0]) if r[0] is not None else None for r in rows], pa.string()),
            "seq": pa.array([r[1] for r in rows], pa.int64()),
        }
    )
    pq.write_table(table, path)


def test_stream_restart_and_replay(spark, scratch):
    src = scratch + "/in"
    os.makedirs(src)
    schema = "value string, seq long"
    _write_events(src + "/a.parquet", [({"timestamp": "2024-01-01 00:00:00", "current_reading": 1.0}, 1)])
    log_path, ckpt = scratch + "/log", scratch + "/ckpt"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        parsed = IN.parse_readings(stream, IN.LOAD_SCHEMA, "timestamp")
        q = IN.start_ingest(
            parsed, log_path, ckpt, IN.load_cells(), trigger={"availableNow": True},
            reject_path=scratch + "/rej", metrics_path=scratch + "/metrics",
        )
        IN.run_for(q, 120)

    run()
    _write_events(
        src + "/b.parquet",
        [({"timestamp": "2024-01-01 00:00:00"}, 2), ({"timestamp": "", "current_reading": 9.0}, 3)],
    )
    run()  # restart on the same checkpoint: only the new file is read
    log = KV.kv_read_log(spark, log_path)
    assert sorted(r.batch_id for r in log.select("batch_id").distinct().collect()) == [0, 1]
    cur = KV.kv_current(log, "key", ("batch_id", "seq"), IN.load_cells()).collect()
    assert len(cur) == 1 and cur[0].current_reading == 1.0 and cur[0].seq == 2  # empty key rejected
    rej = spark.read.parquet(scratch + "/rej").collect()
    assert [(r.seq, r.batch_id) for r in rej] == [(3, 1)]
    metrics = sorted(tuple(r) for r in spark.read.parquet(scratch + "/metrics").select("batch_id", "rows", "rejected", "written").collect())
    assert metrics == [(0, 1, 0, 1), (1, 2, 1, 1)]


def test_unfinished_stream_raises(spark, scratch):
    src = scratch + "/in"
    os.makedirs(src)
    for i in range(40):
        _write_events(f"{src}/{i:02}.parquet", [({"timestamp": "2024-01-01 00:00:00", "current_reading": float(i)}, i)])
    stream = spark.readStream.schema("value string, seq long").option("maxFilesPerTrigger", 1).parquet(src)
    parsed = IN.parse_readings(stream, IN.LOAD_SCHEMA, "timestamp")
    q = IN.start_ingest(parsed, scratch + "/log", scratch + "/ckpt", IN.load_cells(), trigger={"availableNow": True})
    with pytest.raises(TimeoutError):
        IN.run_for(q, 1)
    assert not q.isActive


def test_continuous_stream_may_be_stopped(spark, scratch):
    src = scratch + "/in"
    os.makedirs(src)
    _write_events(src + "/a.parquet", [({"timestamp": "2024-01-01 00:00:00", "current_reading": 1.0}, 1)])
    parsed = IN.parse_readings(spark.readStream.schema("value string, seq long").parquet(src), IN.LOAD_SCHEMA, "timestamp")
    q = IN.start_ingest(parsed, scratch + "/log", scratch + "/ckpt", IN.load_cells(), trigger={"processingTime": "1 seconds"})
    IN.run_for(q, 1, continuous=True)
    assert not q.isActive


@pytest.mark.parametrize("fn", [IN.load_messages, IN.weather_messages])
def test_message_adapters_make_json(spark, fn):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    first = fn(ev).first()
    assert first.value.startswith("{") and first.seq is not None


def test_incremental_merge_equals_full_merge(spark, scratch):
    log_path = scratch + "/log"
    schema = "key string, seq long, v double, p string"
    KV.kv_write_batch(spark.createDataFrame([("k", 1, 1.0, "a"), ("j", 2, 5.0, "x")], schema), log_path, 0)
    KV.kv_write_batch(spark.createDataFrame([("k", 3, None, "b")], schema), log_path, 1)
    KV.kv_compact(spark, log_path, scratch + "/snap", "key", ("batch_id", "seq"), ["v", "p"])
    KV.kv_write_batch(spark.createDataFrame([("k", 4, 7.0, None), ("m", 5, None, "z")], schema), log_path, 2)
    inc = KV.kv_current_incremental(spark, scratch + "/snap", log_path, "key", ("batch_id", "seq"), ["v", "p"])
    full = KV.kv_current(KV.kv_read_log(spark, log_path), "key", ("batch_id", "seq"), ["v", "p"])
    rows = lambda df: sorted(tuple(r) for r in df.select("key", "seq", "v", "p").collect())
    assert rows(inc) == rows(full)
    assert dict((r.key, (r.v, r.p)) for r in inc.collect())["k"] == (7.0, "b")
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "(batch_id#" in plan


def test_range_scan_prunes_day_partitions(spark, scratch):
    kv = spark.createDataFrame(
        [("2024-01-0%d %02d:00:00" % (d, h), float(h)) for d in range(1, 6) for h in (0, 12)], "key string, v double"
    )
    KV.kv_write_by_day(kv, scratch + "/kv")
    t = spark.read.parquet(scratch + "/kv")
    scan = KV.range_scan(t, "2024-01-02 00:00:00", "2024-01-03 00:00:00", partition_col="dt")
    assert sorted(r.key for r in scan.collect()) == ["2024-01-02 00:00:00", "2024-01-02 12:00:00"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_cell = st.one_of(st.none(), st.integers(0, 9).map(float))


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(
    batches=st.lists(
        st.lists(st.tuples(st.sampled_from("abc"), _cell, _cell), min_size=1, max_size=6), min_size=1, max_size=4
    ),
    order=st.randoms(use_true_random=False),
)
def test_upsert_matches_brute_force_under_replay(spark, scratch, batches, order):
    """Writing batches in any order, with replays, gives the brute-force latest-non-null merge."""
    import uuid

    log_path = f"{scratch}/kvlog-{uuid.uuid4().hex}"
    schema = "key string, seq long, v double, w double"
    frames, seq = [], 0
    for rows in batches:
        out = []
        for k, v, w in rows:
            out.append((k, seq, v, w))
            seq += 1
        frames.append(out)
    ids = list(range(len(frames))) + [0] * 2  # batch 0 replayed twice
    order.shuffle(ids)
    for b in ids:
        KV.kv_write_batch(spark.createDataFrame(frames[b], schema), log_path, b)
    got = {
        r.key: (r.seq, r.v, r.w)
        for r in KV.kv_current(KV.kv_read_log(spark, log_path), "key", ("batch_id", "seq"), ["v", "w"]).collect()
    }
    expect: dict = {}
    for b, rows in enumerate(frames):
        for k, s, v, w in rows:
            old = expect.get(k, (None, None, None))
            expect[k] = (s, v if v is not None else old[1], w if w is not None else old[2])
    assert got == expect


def test_cells_round_trip_to_typed_rows(spark):
    df = spark.createDataFrame(
        [("k", 1, 1.5, "a"), ("k", 2, None, "b"), ("j", 3, 2.0, None)], "key string, seq long, v double, p string"
    )
    cells = KV.kv_cells(df, "key", "seq", ["v", "p"])
    back = {r.key: r for r in KV.kv_from_cells(cells, {"v": "double", "p": "string"}).collect()}
    assert back["k"].v == 1.5 and back["k"].p == "b" and back["k"].seq == 2
    assert back["j"].p is None and back["j"].v == 2.0
    cur = {r.key: r for r in KV.kv_current(df, "key", ("seq",), ["v", "p"]).collect()}
    assert {k: (r.v, r.p) for k, r in cur.items()} == {k: (r.v, r.p) for k, r in back.items()}


def test_stateful_current_view_equals_log_merge(spark, scratch):
    src = scratch + "/in"
    os.makedirs(src)
    rows_a = [({"timestamp": "2024-01-01 00:00:00", "current_reading": 1.0}, 1), ({"timestamp": "2024-01-01 01:00:00", "current_reading": 5.0}, 2)]
    rows_b = [({"timestamp": "2024-01-01 00:00:00"}, 3), ({"timestamp": "2024-01-01 01:00:00", "current_reading": 6.0}, 4), ({"timestamp": "", "current_reading": 9.0}, 5)]
    _write_events(src + "/a.parquet", rows_a)
    schema = "value string, seq long"

    def run(kind):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        parsed = IN.parse_readings(stream, IN.LOAD_SCHEMA, "timestamp")
        trig = {"availableNow": True}
        if kind == "state":
            q = IN.start_current_view(parsed, scratch + "/cur", scratch + "/ck_state", IN.load_cells(), trigger=trig)
        else:
            q = IN.start_ingest(parsed, scratch + "/log", scratch + "/ck_log", IN.load_cells(), trigger=trig)
        IN.run_for(q, 120)

    run("state"); run("log")
    _write_events(src + "/b.parquet", rows_b)
    run("state"); run("log")  # restart: state restored from the checkpoint
    state = {r.key: (r.seq, r.current_reading) for r in IN.read_current_view(spark, scratch + "/cur", IN.load_cells()).collect()}
    log = {
        r.key: (r.seq, r.current_reading)
        for r in KV.kv_current(KV.kv_read_log(spark, scratch + "/log"), "key", ("batch_id", "seq"), IN.load_cells()).collect()
    }
    assert state == log == {"2024-01-01 00:00:00": (3, 1.0), "2024-01-01 01:00:00": (4, 6.0)}


@pytest.mark.parametrize(("order", "kind"), [(("b", "seq"), "int"), (("b", "seq"), "string"), (("seq",), "int"), (("seq",), "string")])
def test_a_null_order_value_comes_first(spark, order, kind):
    """One number, a struct of both or one column: a value whose seq is null is older, and isn't lost."""
    rows = [("k", 0, 1, "a"), ("k", 1, None, "b"), ("z", 1, None, "c"), ("y", 1, None, "d"), ("y", 1, 2, None), ("x", None, 5, "e"), ("x", 0, None, "f")]
    log = spark.createDataFrame(rows, "key string, b int, seq long, v string")
    log = log.withColumn("b", F.col("b").cast(kind)).withColumn("seq", F.col("seq").cast("long" if kind == "int" else kind))
    got = {r.key: (r.v, None if r.seq is None else int(r.seq)) for r in KV.kv_current(log, "key", order, ["v"]).collect()}
    both = {"k": ("b", None), "z": ("c", None), "y": ("d", 2), "x": ("f", None)}
    assert got == (both if len(order) == 2 else {"k": ("a", 1), "z": ("c", None), "y": ("d", 2), "x": ("e", 5)})


def test_extreme_order_values(spark):
    """The largest and smallest long after the packing and back."""
    low, high = -(2**63), 2**63 - 1
    log = spark.createDataFrame([("a", 1, low, "x"), ("a", 1, None, "y"), ("b", -3, high, "x"), ("b", -2, low, "y"), ("c", 10**18 - 1, high, "z")], "key string, b long, seq long, v string")
    assert {tuple(r) for r in KV.kv_current(log, "key", ("b", "seq"), ["v"]).collect()} == {("a", low, "x"), ("b", low, "y"), ("c", high, "z")}


def test_cells_with_a_null_sequence(spark):
    cells = spark.createDataFrame([("k", None, "v", "1"), ("k", 0, "v", "2"), ("z", None, "v", "3")], "key string, seq long, column string, value string")
    assert {(r.key, r.v) for r in KV.kv_from_cells(cells, {"v": "int"}).collect()} == {("k", 2), ("z", 3)}


@pytest.mark.parametrize("ids", ["id", "id % 5", "nullif(id % 400, 0)"])
def test_a_long_batch_is_read_from_several_files(spark, scratch, monkeypatch, ids):
    """Eight batches whatever their size, each in as many files as its messages are worth tasks; repeated and null ids too."""
    events = spark.range(2000).select(
        F.expr(ids).alias("event_id"), F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("click").alias("event_type"), F.col("id").cast("double").alias("value"), F.lit("{}").alias("props"),
    )
    events.write.parquet(scratch + "/events.parquet")
    monkeypatch.setattr(CA, "_FILE_MESSAGES", 100, raising=False)
    made = []
    monkeypatch.setattr(CA, "scratch_path", lambda s, label, f=CA.scratch_path: made.append(f(s, label)) or made[-1])
    counts = CA.q_stream_metrics(spark, scratch).first()
    source = spark.read.parquet(next(p for p in made if "/stream-in-" in p))
    assert source.count() == 2000 and len(source.inputFiles()) == 24
    kept, rejected = (events.where(f"event_id % 50 {c}") for c in ("not in (0, 3)", "= 1"))
    assert tuple(counts)[1:] == (kept.count(), rejected.count(), kept.count() - rejected.count())
    assert counts.batches == 8 or ids == "id % 5"  # where the first is all null keys, it isn't counted
    replayed = [(r.seq, r.current_reading) for r in CA.q_stream_replay(spark, scratch).collect()]
    assert sorted(replayed) == sorted((r.event_id, r.value) for r in kept.where("event_id % 50 <> 1").collect())
