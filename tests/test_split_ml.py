"""Time split properties, model training, persistence and the 24-hour forecast."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF01
from loadcast.ml import model as ML
from loadcast.operators import split as SP
from loadcast.operators.features import final_features, join_raw
from loadcast.plans import forecast as FC
from loadcast.sources import adapters as AD


@pytest.fixture(scope="module")
def feats(spark):
    ev = AD.read_table(spark, SF01, "events")
    df = final_features(AD.load_series(ev), AD.weather_series(ev)).drop("datetime_ept")
    return df.persist()


@pytest.fixture(scope="module")
def split(feats):
    return SP.time_split(feats, 0.8)


def test_split_partition_and_order(feats, split):
    train, test = split
    n = feats.count()
    assert train.count() == int(0.8 * n) and test.count() == n - int(0.8 * n)
    assert train.unionByName(test).exceptAll(feats).count() == 0
    assert feats.exceptAll(train.unionByName(test)).count() == 0
    b = SP.split_bounds(train, test).first()
    assert b.ordered and b.train_max_ts < b.test_min_ts
    assert SP.test_by_except_all(feats, train).exceptAll(test).count() == 0


@pytest.mark.parametrize("ratio", [0.0, 0.37, 0.8, 1.0])
def test_split_on_kept_numbers_is_the_same(spark, ratio):
    # numbers with gaps, as the warm-up filter leaves them, and stretches without a row
    df = spark.range(0, 4000, 7, 5).where("id < 900 or id > 2500").select(F.col("id").alias("rn"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    n = df.count()
    for stretch in (1, 64, 1 << 20):
        first = SP.first_test_number(df, ratio, "rn", stretch)
        numbers = sorted(r.rn for r in df.collect())
        assert first == (numbers[int(ratio * n)] if int(ratio * n) < n else None)
    train, test = SP.time_split(df, ratio, rn="rn")
    again = SP.time_split(df.drop("rn"), ratio)
    assert [sorted(r.ts for r in d.collect()) for d in (train, test)] == [sorted(r.ts for r in d.collect()) for d in again]
    assert SP.first_test_number(df.where("false"), ratio, "rn") is None


@pytest.mark.parametrize("query", ["split_train", "split_bounds", "split_except_all", "assembler_split_rows", "rmse_seasonal"])
def test_split_queries_number_rows_once(spark, monkeypatch, query):
    from loadcast.operators import sequence

    folders = []
    monkeypatch.setattr(sequence, "scratch_path", lambda s, label, f=sequence.scratch_path: folders.append(label) or f(s, label))
    E.queries()[query](spark, SF01).count()
    assert folders == ["sequence"]


def test_split_plan_has_no_large_limit(split):
    train, _ = split
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan


def test_nineteen_features(feats):
    cols = ML.feature_columns(feats)
    assert len(cols) == 19 and "mw" not in cols and "ts" not in cols


@pytest.fixture(scope="module")
def trained(split):
    train, test = split
    return ML.train(train, grid={"numTrees": [10], "maxDepth": [5]}, folds=2), train, test


def test_model_beats_constant_and_reloads(spark, trained, scratch):
    model, train, test = trained
    scored = ML.score(model, test)
    rmse = ML.rmse_value(scored)
    mean = train.agg(F.avg("mw")).first()[0]
    const = ML.rmse(test.withColumn("c", F.lit(mean)), pred="c").first().rmse
    assert math.isfinite(rmse) and rmse < const
    ML.save_model(model, scratch + "/m")
    again = ML.score(ML.load_model(scratch + "/m"), test)
    a = sorted((r.ts, r.prediction) for r in scored.collect())
    b = sorted((r.ts, r.prediction) for r in again.collect())
    assert a == b
    assert ML.load_model(scratch + "/missing") is None


def test_feature_importance_sorted(trained):
    imp = [r.importance for r in ML.feature_importance(trained[0]).collect()]
    assert imp == sorted(imp, reverse=True) and all(x > 0.005 for x in imp)


def test_forecast_24_rows_all_features(spark, trained):
    ev = AD.read_table(spark, SF01, "events")
    joined = join_raw(AD.load_series(ev), AD.weather_series(ev))
    inputs = FC.forecast_inputs(joined)
    assert inputs.count() == 24
    feats = ML.feature_columns(inputs.drop("mw"))
    assert len(feats) == 19
    # every feature known for every forecast hour, so the assembler skips none
    assert inputs.dropna(subset=feats).count() == 24
    preds = FC.forecast(trained[0], inputs)
    assert preds.count() == 24 and preds.where(F.col("predicted_load_mw").isNull()).count() == 0
    last = joined.agg(F.max("ts")).first()[0]
    first = preds.agg(F.min("ts")).first()[0]
    assert (first - last).total_seconds() == 3600


def test_append_predictions_rerun_replaces(spark, trained, scratch):
    ev = AD.read_table(spark, SF01, "events")
    inputs = FC.forecast_inputs(join_raw(AD.load_series(ev), AD.weather_series(ev)))
    preds = FC.forecast(trained[0], inputs)
    FC.append_predictions(preds, scratch + "/preds", "run1")
    FC.append_predictions(preds, scratch + "/preds", "run1")
    FC.append_predictions(preds, scratch + "/preds", "run2")
    out = spark.read.parquet(scratch + "/preds")
    assert out.count() == 48 and out.select("run_id").distinct().count() == 2


def test_rmse_exact_cents(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0)], "y double, p double")
    r = ML.rmse(df, "y", "p", exact_cents=True).first()
    assert r.n == 2 and abs(r.rmse - math.sqrt((0.25 + 1.0) / 2)) < 1e-12


def test_time_folds_are_contiguous(feats):
    folded = SP.time_folds(feats, 3)
    spans = {r.fold: (r.lo, r.hi) for r in folded.groupBy("fold").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()}
    assert sorted(spans) == [0, 1, 2]
    assert spans[0][1] < spans[1][0] and spans[1][1] < spans[2][0]


def test_train_with_time_folds(split):
    train, _ = split
    folded = SP.time_folds(train, 2)
    model = ML.train(folded, grid={"numTrees": [5], "maxDepth": [3]}, folds=2, fold_col="fold")
    assert len(ML.best_pipeline(model).stages[0].getInputCols()) == 19


def test_first_rows_is_preview(feats):
    rows = SP.first_rows(feats, 5).collect()
    assert len(rows) == 5 and [r.ts for r in rows] == sorted(r.ts for r in rows)


def test_assert_split_ordered(spark, feats, split):
    train, test = split
    assert SP.assert_split_ordered(train, test).first().ordered
    with pytest.raises(AssertionError):
        SP.assert_split_ordered(test, train)


def test_forecast_explicit_start(spark):
    import datetime as dt

    ev = AD.read_table(spark, SF01, "events")
    joined = join_raw(AD.load_series(ev), AD.weather_series(ev))
    inputs = FC.forecast_inputs(joined, start="2024-01-31 05:00:00", hours=6)
    ts = sorted(r.ts for r in inputs.select("ts").collect())
    assert ts[0] == dt.datetime(2024, 1, 31, 5) and len(ts) == 6


def test_sequence_of_empty_input(spark):
    from loadcast.operators.sequence import with_sequence

    empty = spark.read.parquet(SF01 + "/events.parquet").where("event_id < 0")
    assert with_sequence(empty, ["ts", "event_id"]).count() == 0


def test_forecast_longer_horizons_have_every_feature(spark):
    ev = AD.read_table(spark, SF01, "events")
    joined = join_raw(AD.load_series(ev), AD.weather_series(ev))
    for hours in (72, 200):
        inputs = FC.forecast_inputs(joined, hours=hours)
        feats = ML.feature_columns(inputs.drop("mw"))
        assert inputs.count() == hours
        assert inputs.dropna(subset=feats).count() == hours, hours


def test_one_pass_bounds_equal_two_frame_bounds(feats):
    train, test, bounds = SP.time_split_with_bounds(feats, 0.8)
    a = bounds.first().asDict()
    b = SP.split_bounds(train, test).first().asDict()
    assert a == b and a["ordered"]


@pytest.mark.parametrize("search", [ML.train, ML.train_forward])
def test_few_rows_in_many_partitions_are_trained_in_few_tasks(spark, monkeypatch, search):
    """A search has hundreds of stages with a task a partition: the rows say how many, not the exchange they come from."""
    frame = spark.range(300).select(F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.rand(1).alias("x"), F.rand(2).alias("mw")).repartition(211, "ts")
    tasks = []
    monkeypatch.setattr(ML.Pipeline, "fit", lambda self, df, *a, f=ML.Pipeline.fit: tasks.append(df.rdd.getNumPartitions()) or f(self, df, *a))
    monkeypatch.setattr(ML.CrossValidator, "fit", lambda self, df, f=ML.CrossValidator.fit: tasks.append(df.rdd.getNumPartitions()) or f(self, df))
    model = search(frame, grid={"numTrees": [2], "maxDepth": [2]}, folds=2)
    assert tasks and max(tasks) == 1
    assert ML.score(model, frame).count() == 300


def test_training_cache_keeps_every_row(spark):
    cores = spark.sparkContext.defaultParallelism
    frame = spark.range(1000).select((F.col("id") % 400).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("b"))
    rows = sorted(map(repr, frame.collect()))
    dealt = []
    for parts in (cores, 3 * cores + 50):
        many = frame.repartition(parts, "a")
        with ML.training_cache(many, task_rows=300) as cached:
            assert sorted(map(repr, cached.collect())) == rows
            assert cached.rdd.getNumPartitions() == (4 if parts > max(4, 2 * cores) else parts)
            dealt.append(cached.rdd.glom().collect())
        with ML.training_cache(many, task_rows=300) as cached:  # alike again, for seeded folds
            assert cached.rdd.glom().collect() == dealt[-1]
        assert not many.storageLevel.useMemory
    with ML.training_cache(frame.where("a < 0").repartition(3 * cores + 50)) as cached:
        assert cached.count() == 0
