"""The manifest: equals the plain merge, names no folded folder, grace period, races, replays, day pruning."""

import random

import pytest
from pyspark.sql import functions as F

from loadcast.operators import compaction as CP
from loadcast.operators import kv as KV
from loadcast.plans import serving as SV

SCHEMA = "key string, seq long, v string, p double"


def batch(spark, log, number, rows):
    KV.kv_write_batch(KV.with_day(spark.createDataFrame(rows, SCHEMA)), log, number, partition_by=KV.DAY)


def random_rows(rnd, n):
    keys = [f"2024-01-0{d} 0{h}:00:00" for d in range(1, 5) for h in range(3)] + ["", "soon", "2024-01-02"]
    return [(rnd.choice(keys), rnd.choice([None, *range(9)]) if i else 10, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, float(i)])) for i in range(n)]


def merged(rows):
    """Brute force: (batch, seq, ...) in order, each cell's last value that isn't null."""
    out = {}
    for _, key, seq, v, p in sorted(rows, key=lambda r: (r[0], r[2] is not None, r[2] or 0)):
        old = out.get(key, (None, None, None))
        out[key] = (seq, v if v is not None else old[1], p if p is not None else old[2])
    return {(k, *v) for k, v in out.items()}


def test_compactions_equal_the_plain_merge(spark, scratch):
    """Four compactions between ten batches; sequence numbers are unique per batch and key."""
    log, rnd, rows, folded = scratch + "/log", random.Random(3), [], set()
    for b in range(10):
        new = {(r[0], r[1]): r for r in random_rows(rnd, 12)}  # one row for each (key, seq)
        batch(spark, log, b, list(new.values()))
        rows += [(b, *r) for r in new.values()]
        if b in (1, 4, 5, 8):
            made = CP.compact(spark, log, cells=["v", "p"])
            folded |= {f"{KV.BATCH}={i}/" for i in range(b + 1)}
            assert made.through == b
        now = CP.read_current(spark, log, cells=["v", "p"])
        assert {tuple(r) for r in now.drop(KV.DAY).collect()} == merged(rows)
        assert not any(f in path for path in now.inputFiles() for f in folded)
    whole = KV.kv_current(KV.kv_read_log(spark, log), "key", (KV.BATCH, "seq"), ["v", "p"])
    assert {tuple(r) for r in whole.collect()} == merged(rows)  # the folded batches are kept for a day


def test_only_the_days_that_changed_are_written(spark, scratch):
    log = scratch + "/log"
    batch(spark, log, 0, [("2024-01-01 00:00:00", 1, "a", None), ("2024-01-02 00:00:00", 1, "b", None)])
    first = CP.compact(spark, log, cells=["v", "p"])
    batch(spark, log, 1, [("2024-01-02 01:00:00", 1, "c", None)])
    second = CP.compact(spark, log, cells=["v", "p"])
    assert second.days["2024-01-01"] == first.days["2024-01-01"]
    assert second.days["2024-01-02"] != first.days["2024-01-02"]
    assert CP.compact(spark, log, cells=["v", "p"]) == second  # nothing new


def test_grace_period(spark, scratch):
    """A reader of an older version can go on; without grace its folders are gone."""
    log = scratch + "/log"
    batch(spark, log, 0, [("2024-01-01 00:00:00", 1, "a", None)])
    CP.compact(spark, log, cells=["v", "p"])
    older = CP.read_current(spark, log, cells=["v", "p"])
    batch(spark, log, 1, [("2024-01-01 00:00:00", 1, "b", None)])
    CP.compact(spark, log, cells=["v", "p"])
    assert older.first().v == "a"
    swept = CP.sweep(spark, log, grace_s=0)
    assert swept.retired == [] and CP.read_current(spark, log, cells=["v", "p"]).first().v == "b"
    folder = CP._Folder(spark, log)
    assert not any(n.startswith(KV.BATCH) for n in folder.names()) and len(folder.names("_snapshots")) == 2
    assert len(folder.names(swept.days["2024-01-01"].rsplit("/", 1)[0])) >= 1 and len(CP._versions(folder)) == 2


def test_two_compactions_at_a_time(spark, scratch, monkeypatch):
    """The second one fails and leaves what the first wrote."""
    log = scratch + "/log"
    batch(spark, log, 0, [("2024-01-01 00:00:00", 1, "a", None)])
    stale = CP.read_manifest(spark, log)
    won = CP.compact(spark, log, cells=["v", "p"])
    with monkeypatch.context() as m:
        m.setattr(CP, "read_manifest", lambda *_: stale)
        with pytest.raises(RuntimeError, match="another compaction"):
            CP.compact(spark, log, cells=["v", "p"])
    assert CP.read_manifest(spark, log) == won
    assert len(CP._Folder(spark, log).names("_snapshots")) == 1


def test_a_batch_being_written_waits(spark, scratch):
    log = scratch + "/log"
    for b in range(3):
        batch(spark, log, b, [("2024-01-01 00:00:00", b, "abc"[b], None)])
    CP._Folder(spark, log).delete(f"{KV.BATCH}=1/_SUCCESS")
    assert CP.compact(spark, log, cells=["v", "p"]).through == 0
    assert CP.read_current(spark, log, cells=["v", "p"]).first().v == "c"


def test_replayed_batches(spark, scratch):
    log = scratch + "/log"
    for b in range(2):
        batch(spark, log, b, [("2024-01-01 00:00:00", b, "ab"[b], None)])
    assert not CP.is_folded(spark, log, 1)
    CP.compact(spark, log, cells=["v", "p"])
    assert CP.is_folded(spark, log, 1) and not CP.is_folded(spark, log, 2)
    with pytest.raises(ValueError, match="needs a new log"):
        CP.is_folded(spark, log, 0)


def test_an_empty_log(spark, scratch):
    assert CP.compact(spark, scratch + "/none", cells=["v"]) == CP.Manifest()
    with pytest.raises(FileNotFoundError):
        CP.read_current(spark, scratch + "/none", cells=["v"])


def test_a_day_reads_only_its_folders(spark, scratch):
    """Both the folded and the live days are pruned; keys without a day are looked at."""
    log = scratch + "/log"
    batch(spark, log, 0, [(f"2024-01-0{d} 00:00:00", 1, "a", 1.0) for d in range(1, 6)] + [("2024-01-03-odd", 1, "o", 1.0), ("zz", 1, "z", 1.0)])
    CP.compact(spark, log, cells=["v", "p"])
    batch(spark, log, 1, [(f"2024-01-0{d} 00:00:00", 1, None, 2.0) for d in range(2, 5)])
    day = KV.range_scan(CP.read_current(spark, log, cells=["v", "p"]), "2024-01-03 00:00:00", "2024-01-04 00:00:00", partition_col=KV.DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert {(r.key, r.v, r.p) for r in day.collect()} == {("2024-01-03 00:00:00", "a", 2.0), ("2024-01-03-odd", "o", 1.0)}
    assert plan.count("PartitionFilters: [") == 2 and plan.count("PartitionFilters: []") == 0 and plan.count("PushedFilters: []") == 0


def test_combined_prunes_all_three_tables(spark, scratch):
    """The day and the key range reach the scans below the merge of the logs."""
    for name, cell in (("load", "current_reading"), ("weather", "temp")):
        rows = spark.range(96).select(
            F.date_format(F.timestamp_seconds(F.col("id") * 3600 + 1704067200), "yyyy-MM-dd HH:mm:ss").alias("key"), F.col("id").alias("seq"),
            F.col("id").cast("double").alias(cell), *[F.lit(1.0).alias(c) for c in ("hmdt", "wnd_spd")],
        )
        KV.kv_write_batch(KV.with_day(rows), f"{scratch}/{name}", 0, partition_by=KV.DAY)
    load = CP.read_current(spark, scratch + "/load", cells=["current_reading"])
    weather = CP.read_current(spark, scratch + "/weather", cells=["temp", "hmdt", "wnd_spd"])
    KV.kv_write_by_day(load.select(F.col("key").alias("row_key"), F.lit(5.0).alias("prediction_value")), scratch + "/pred", key="row_key")
    comb = SV.combined(KV.kv_read_log(spark, scratch + "/pred"), load, weather, date="2024-01-02")
    plan = comb._jdf.queryExecution().executedPlan().toString()
    assert comb.count() == 24 and comb.agg(F.min("actual"), F.max("actual")).first()[:] == (24.0, 47.0)
    assert plan.count("PartitionFilters: [") == 3 and plan.count("PartitionFilters: []") == 0
    assert "2024-01-02" in plan
