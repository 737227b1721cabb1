"""Cuts by selection: every cut of small tables, ties, copies, nulls, several rounds, and the plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadcast.operators import selection as SE
from loadcast.operators import split as SP


def ordered(df, time="ts"):
    """All rows in the operator's order, by one sort."""
    return [tuple(r)[:-2] for r in df.select("*", SE._number(df, time).alias("_v"), SE._row_hash(df).alias("_h")).orderBy("_v", "_h").collect()]


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize(("ranges", "few"), [(4096, 4096), (4, 0), (2, 3)])
def test_every_cut_of_a_table_with_ties_and_copies(spark, monkeypatch, ranges, few):
    """Many rounds (two ranges a round), single instants with many rows, rows alike in all columns, null times."""
    monkeypatch.setattr(SE, "RANGES", ranges)
    monkeypatch.setattr(SE, "FEW", few)
    rnd = random.Random(ranges)
    base = dt.datetime(2024, 3, 10, 1, 30)
    rows = [(rnd.choice([None, base, base + dt.timedelta(hours=rnd.randint(-3, 3)), base + dt.timedelta(microseconds=1)]), rnd.choice("ab")) for _ in range(13)]
    rows += [(base, "copy")] * 9
    df = spark.createDataFrame(rows, "ts timestamp_ntz, name string").repartition(3).cache()
    want = ordered(df)
    for k in (0, 1, 9, 15, 21, 30):
        _, (cut,) = SE.find_cuts(df, [k])
        before, after = SE.split_at(df, cut)
        assert rows_of(before) == sorted(map(repr, want[:k])) and rows_of(after) == sorted(map(repr, want[k:]))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "long"])
def test_kinds_of_time(spark, kind):
    df = spark.range(100).select(F.when(F.col("id") % 9 > 0, F.expr("timestamp_seconds(id * 40000)")).alias("t"), "id")
    df = df.select((F.col("t").cast("timestamp").cast("long") if kind == "long" else F.col("t").cast(kind)).alias("ts"), "id")
    train, test = SE.select_split(df, 0.37)
    want = ordered(df)
    assert rows_of(train) == sorted(map(repr, want[:37])) and rows_of(test) == sorted(map(repr, want[37:]))
    with pytest.raises(TypeError, match="not a time"):
        SE.select_split(df.select(F.lit("x").alias("ts")), 0.5)


def test_extreme_numbers_and_empty_tables(spark):
    values = [-(2**63) + 1, -1, 0, 1, 2**63 - 1] * 2
    df = spark.createDataFrame([(v,) for v in values], "ts long")
    for k in (0, 1, 5, 9, 10):
        _, (cut,) = SE.find_cuts(df, [k])
        before, after = SE.split_at(df, cut)
        assert [r.ts for r in before.orderBy("ts").collect()] == sorted(values)[:k] and after.count() == 10 - k
    none = df.where("false")
    assert [x.count() for x in SE.select_split(none, 0.8)] == [0, 0]
    assert [(a.count(), b.count()) for a, b in SE.forward_folds(none, 2)] == [(0, 0), (0, 0)]
    with pytest.raises(ValueError, match="one fold"):
        SE.forward_folds(df, 0)


def test_agrees_with_the_numbered_split_and_neither_sorts_nor_writes(spark, scratch):
    """On a stored table with one row a time; the plan is two scans with a filter."""
    stored = spark.range(5000).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"), F.col("id").alias("v"))
    stored.repartition(4).write.parquet(scratch + "/t")
    df = spark.read.parquet(scratch + "/t")
    train, test = SE.select_split(df, 0.8)
    old_train, old_test = SP.time_split(df, 0.8)
    assert rows_of(train) == rows_of(old_train) and rows_of(test) == rows_of(old_test)
    for part in (train, test):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Exchange" not in plan and "Window" not in plan and len(part.inputFiles()) == 4


def test_folds_never_learn_from_the_future(spark):
    df = spark.range(103).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), "id").repartition(5)
    folds = [([r.id for r in a.orderBy("id").collect()], [r.id for r in b.orderBy("id").collect()]) for a, b in SE.forward_folds(df, 4)]
    bounds = [20, 41, 61, 82, 103]
    assert folds == [(list(range(a)), list(range(a, b))) for a, b in zip(bounds, bounds[1:])]


def test_train_forward_picks_the_grid_point_with_the_least_mean_error(spark):
    from loadcast.ml import model as ML

    df = spark.range(400).select(F.timestamp_seconds(F.col("id") * 3600).alias("ts"), (F.col("id") % 24).cast("double").alias("hour"))
    df = df.withColumn("mw", F.col("hour") * 10 + 5)
    model = ML.train_forward(df, grid={"numTrees": [5], "maxDepth": [1, 5]}, folds=2)
    assert len(model.avgMetrics) == 2 and model.avgMetrics[1] < model.avgMetrics[0]
    assert model.bestModel.stages[-1].getMaxDepth() == 5 and len(model.getEstimatorParamMaps()) == 2
    assert ML.rmse_value(ML.score(model, df)) < 5
