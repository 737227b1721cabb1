"""Expiring state against brute force, its size; the live join's late rows; stopping between batches; progress rows."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from loadcast.streaming import control as CO
from loadcast.streaming import expiring as EX
from loadcast.streaming import ingest as IN
from loadcast.streaming import live as LI

NOW = {"availableNow": True}


def reading(hour, value, seq):
    return (f'{{"timestamp": "2024-01-01 {hour:02d}:00:00", "current_reading": {"null" if value is None else value}}}', seq)


def put(spark, folder, part, rows):
    spark.createDataFrame(rows, "value string, seq long").coalesce(1).write.parquet(f"{folder}/part={part}")


def source(spark, folder, **kw):
    return IN.parse_readings(IN.file_message_stream(spark, f"{folder}/part=*", "value string, seq long", **kw).select("value", "seq"), IN.LOAD_SCHEMA, "timestamp")


@pytest.mark.parametrize("ttl", [0.5, 3600])
def test_expiring_state_equals_the_merge_of_all_readings(spark, scratch, ttl):
    """Null readings keep the older value even when the state that knew it has expired; a null seq comes first."""
    rounds = [
        [reading(1, 5.0, 1), reading(2, 6.0, 2), reading(2, None, 3), reading(3, None, 9), reading(4, 1.0, None), reading(4, 2.0, 0)],
        [reading(1, None, 4), reading(3, 8.0, 1), ("{broken", 5), reading(5, 7.5, 6)],
        [reading(1, 5.0, 1), reading(2, None, 3)],  # replayed
    ]
    states = []
    for i, rows in enumerate(rounds):
        put(spark, scratch + "/in", i, rows)
        q = EX.start_expiring_view(source(spark, scratch + "/in"), scratch + "/out", scratch + "/ckpt", IN.load_cells(), ttl, trigger=NOW)
        IN.run_for(q, 300)
        states.append(sum(s.numRowsTotal for p in q.recentProgress[-1:] for s in p.stateOperators))
        time.sleep(1)
    got = {r.key[11:13]: (r.current_reading, r.seq) for r in EX.read_expiring_view(spark, scratch + "/out", IN.load_cells()).collect()}
    assert got == {"01": (5.0, 1), "02": (6.0, 3), "03": (8.0, 1), "04": (2.0, 0), "05": (7.5, 6)}
    if ttl > 1:
        assert states[-1] >= 5
    rows = spark.read.parquet(scratch + "/out")
    assert rows.count() == 4 + 3 + 2  # a row for each key that a batch changed


def test_live_join_counts_late_rows_and_leaves_them_out(spark, scratch):
    name = "late-rows"
    put(spark, scratch + "/load", 0, [reading(h, float(h), h) for h in range(6)])
    put(spark, scratch + "/load", 1, [reading(h, float(h), h) for h in range(6, 20)])
    put(spark, scratch + "/load", 2, [reading(1, 99.0, 50), reading(20, 20.0, 20)])  # the first one far too late
    put(spark, scratch + "/load", 3, [('{"timestamp": "9999-01-01 00:00:00"}', -1)])
    weather = [(f'{{"datetime_ept": "2024-01-01 {h:02d}:00:00", "temp": {h}.5}}', h) for h in range(0, 21, 2)]
    put(spark, scratch + "/weather", 0, weather)
    put(spark, scratch + "/weather", 1, [('{"datetime_ept": "9999-01-01 00:00:00"}', -1)])
    w = IN.file_message_stream(spark, scratch + "/weather/part=*", "value string, seq long", max_files=1).select("value", "seq")
    joined = LI.live_combined(
        source(spark, scratch + "/load", max_files=1), IN.parse_readings(w, IN.WEATHER_SCHEMA, "datetime_ept"), ["current_reading"], ["temp"], delay="3 hours"
    )
    listener = CO.ProgressRows(name)
    spark.streams.addListener(listener)
    try:
        IN.run_for(LI.start_live(joined, scratch + "/out", scratch + "/ckpt", NOW, name), 300)
        rows = listener.frame(spark).agg(F.sum("input_rows").alias("n"), F.sum("late_rows").alias("late"), F.max("state_rows").alias("state")).first()
    finally:
        spark.streams.removeListener(listener)
    got = {r.key[11:13]: (r.current_reading, r.temp) for r in spark.read.parquet(scratch + "/out").collect()}
    assert rows.n == 23 + 12 and 0 < rows.state <= 80
    # every hour of the load, those of odd hours without weather; what came in time is final
    assert got == {f"{h:02d}": (float(h), h + 0.5 if h % 2 == 0 else None) for h in range(21)}
    assert rows.late >= 1


def test_a_stop_waits_for_the_batch_that_is_being_written(spark, scratch):
    """The batch at work ends whole, the next doesn't begin; a restart goes on with it."""
    for i in range(4):
        put(spark, scratch + "/in", i, [reading(i, 1.0, i)])
    gate, began, go = CO.BatchGate(), threading.Event(), threading.Event()
    done = []

    def write(batch, i):
        rows = [r.seq for r in batch.collect()]
        began.set()
        go.wait(60)
        done.append((i, rows))

    def start(w):
        return source(spark, scratch + "/in", max_files=1).writeStream.foreachBatch(w).option("checkpointLocation", scratch + "/ckpt").trigger(**NOW).start()

    query = start(gate.wrap(write))
    assert began.wait(120)
    stopper = threading.Thread(target=gate.stop, args=(query,))
    stopper.start()
    time.sleep(0.5)
    assert query.isActive and not done
    go.set()
    stopper.join(60)
    assert not query.isActive and [i for i, _ in done] == [0]
    IN.run_for(start(CO.BatchGate().wrap(write)), 300)
    assert [i for i, _ in done] in ([0, 1, 2, 3], [0, 0, 1, 2, 3]) and sorted({s for _, rows in done for s in rows}) == [0, 1, 2, 3]


def test_a_gate_stops_an_idle_stream_and_passes_errors_on(spark, scratch):
    put(spark, scratch + "/in", 0, [reading(1, 1.0, 1)])
    gate = CO.BatchGate()
    query = IN.start_ingest(source(spark, scratch + "/in"), scratch + "/log", scratch + "/ckpt", IN.load_cells(), {"processingTime": "1 second"}, gate=gate)
    IN.run_for(query, 15, continuous=True, gate=gate)
    assert not query.isActive and spark.read.parquet(scratch + "/log").count() == 1

    def fail(batch, i):
        raise ValueError("no disk")

    other = CO.BatchGate()
    broken = source(spark, scratch + "/in").writeStream.foreachBatch(other.wrap(fail)).option("checkpointLocation", scratch + "/c2").trigger(**NOW).start()
    with pytest.raises(Exception, match="no disk"):
        IN.run_for(broken, 60, gate=other)
