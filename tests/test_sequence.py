"""Halo-blocked windows equal the global window; numbering is dense and ordered."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadcast.operators.features import lag_profile
from loadcast.operators.sequence import halo_windows, with_sequence


def _frame(spark, n, n_series, dup_ts, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = rnd.randrange(max(1, n // (3 if dup_ts else 1)))
        s = rnd.randrange(n_series)
        v = None if rnd.random() < 0.1 else round(rnd.uniform(-50, 50), 2)
        rows.append((i, ts, s, v))
    return spark.createDataFrame(rows, "id long, t long, s long, v double")


def _collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(
    n=st.integers(1, 700),
    block=st.integers(8, 300),
    parts=st.integers(1, 7),
    n_series=st.integers(1, 4),
    dup_ts=st.booleans(),
    seed=st.integers(0, 10_000),
)
def test_halo_equals_global(spark, n, block, parts, n_series, dup_ts, seed):
    df = _frame(spark, n, n_series, dup_ts, seed).repartition(parts)
    lags = (1, 3, 7)
    ma = 5
    if block < max(*lags, ma):
        block = max(*lags, ma)
    for keys in ((), ("s",)):
        halo = lag_profile(df, "v", order=("t", "id"), series_keys=keys, lags=lags, ma_rows=ma, block=block)
        glob = lag_profile(df, "v", order=("t", "id"), series_keys=keys, lags=lags, ma_rows=ma, method="global")
        cols = ["id", "lag_1", "lag_3", "lag_7", "ma_5"]
        assert _collect(halo, cols) == _collect(glob, cols)


def test_sequence_dense_and_ordered(spark):
    df = _frame(spark, 500, 3, True, 7).repartition(5)
    seq = with_sequence(df, ["t", "id"], series_keys=["s"], num_partitions=6)
    w = Window.partitionBy("s").orderBy("t", "id")
    expect = df.withColumn("rn", F.row_number().over(w) - 1)
    assert _collect(seq, ["id", "rn"]) == _collect(expect, ["id", "rn"])
    seq1 = with_sequence(df, ["t", "id"], num_partitions=4)
    rns = sorted(r.rn for r in seq1.select("rn").collect())
    assert rns == list(range(500))


def test_halo_block_smaller_than_reach_rejected(spark):
    import pytest

    df = with_sequence(_frame(spark, 10, 1, False, 1), ["t", "id"])
    with pytest.raises(ValueError):
        halo_windows(df, {"x": lambda w: F.lag("v", 5).over(w)}, reach=5, block=4)


def test_hot_series_is_split_across_tasks(spark):
    """One series holding most rows still spreads over several blocks."""
    rows = [(i, i, 0 if i % 4 else 1, float(i % 97)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, t long, s long, v double")
    seq = with_sequence(df, ["t", "id"], series_keys=["s"], num_partitions=8)
    blocks = seq.where("s = 0").select(F.expr("rn div 256").alias("b")).distinct().count()
    assert blocks >= 10
    out = lag_profile(df, "v", order=("t", "id"), series_keys=("s",), lags=(1, 24), ma_rows=24, block=256)
    glob = lag_profile(df, "v", order=("t", "id"), series_keys=("s",), lags=(1, 24), ma_rows=24, method="global")
    cols = ["id", "lag_1", "lag_24", "ma_24"]
    assert _collect(out, cols) == _collect(glob, cols)


def test_partition_count_follows_data_size(spark):
    """With a tiny advisory size the exchanges get explicit, larger partition counts."""
    from loadcast.session import parse_bytes, target_partitions
    from loadcast.sources.adapters import event_series

    assert parse_bytes("64m") == 64 << 20 and parse_bytes("67108864b") == 67108864
    df = event_series(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        assert (target_partitions(df) or 0) > 8
        kw = dict(order=("ts", "event_id"), series_keys=("user_id",), lags=(1, 7), ma_rows=5)
        halo = lag_profile(df, "mw", block=64, **kw)
        plan = halo._jdf.queryExecution().executedPlan().toString()
        glob = lag_profile(df, "mw", method="global", **kw)
        cols = ["event_id", "lag_1", "lag_7", "ma_5"]
        assert _collect(halo, cols) == _collect(glob, cols)
        assert "hashpartitioning(user_id" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert target_partitions(df) is None


def test_null_series_key_keeps_its_rows(spark):
    rows = [(i, i // 2, None if i % 3 == 0 else i % 2, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t long, s long, v double")
    halo = lag_profile(df, "v", order=("t", "id"), series_keys=("s",), lags=(1, 5), ma_rows=4, block=16)
    glob = lag_profile(df, "v", order=("t", "id"), series_keys=("s",), lags=(1, 5), ma_rows=4, method="global")
    cols = ["id", "lag_1", "lag_5", "ma_4"]
    assert halo.count() == 300
    assert _collect(halo, cols) == _collect(glob, cols)


def test_scratch_scope_removes_numbering_tables(spark):
    import os

    from loadcast.session import local_path, scratch_scope
    from loadcast.sources.adapters import event_series

    df = event_series(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    with scratch_scope(spark) as created:
        n = lag_profile(df, "mw", order=("ts", "event_id"), lags=(1,), ma_rows=0).count()
        assert created and all(os.path.exists(local_path(p)) for p in created)
    assert n == 1000
    assert not any(os.path.exists(local_path(p)) for p in created)


def test_identical_duplicate_rows_are_split_across_partitions(spark):
    """A third of the rows identical in every column still spread over several range partitions."""
    rows = [(0, 1.0)] * 3000 + [(i, float(i % 7)) for i in range(1, 6001)]
    df = spark.createDataFrame(rows, "t long, v double")
    def parts_of_duplicates(frame):
        return frame.where("t = 0").select(F.spark_partition_id().alias("p")).distinct().count()

    assert parts_of_duplicates(df.repartitionByRange(8, "t", "v")) == 1  # why the salt is needed
    salted = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(8, "t", "v", "_salt")
    assert parts_of_duplicates(salted) >= 2
    seq = with_sequence(df, ["t", "v"], num_partitions=8)
    assert sorted(r.rn for r in seq.select("rn").collect()) == list(range(9000))

    def rows_of(frame):
        cols = ["t", "v", "lag_1", "lag_3", "ma_4"]
        return sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))

    out = lag_profile(df, "v", order=("t", "v"), lags=(1, 3), ma_rows=4, block=512)
    glob = lag_profile(df, "v", order=("t", "v"), lags=(1, 3), ma_rows=4, method="global")
    assert rows_of(out) == rows_of(glob)


def test_reserved_helper_columns_are_rejected(spark):
    import pytest

    df = _frame(spark, 10, 1, False, 2).withColumnRenamed("v", "_mid")
    with pytest.raises(ValueError, match="reserved"):
        with_sequence(df, ["t", "id"])
