"""Random-forest load model with Spark ML (distributed training and scoring).

Features are every column except the target, ``ts`` and the key string
(19 for the feature chain).  Rows with a null feature are skipped by the
assembler, as in the reference.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.operators.features import default_tie_break
from loadcast.operators.selection import forward_folds
from loadcast.schemas import NON_FEATURES

TARGET = "mw"
SEED = 42
# The reference's hyper-parameter grid and fold count.
REFERENCE_GRID = {"numTrees": [20, 50], "maxDepth": [8, 12]}
REFERENCE_FOLDS = 3
#: Training rows that are worth a task of their own.
TASK_ROWS = 8192


def feature_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    numeric = (T.NumericType,)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, numeric) and not f.name.startswith("_")
    ]


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip")


def assembled_rows(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """The rows that survive the assembler's null skip (vector column dropped)."""
    feats = feature_columns(df) if features is None else list(features)
    return assembler(feats, "_vec").transform(df).drop("_vec")


def build_pipeline(features: Sequence[str], label: str = TARGET, seed: int = SEED) -> tuple[Pipeline, RandomForestRegressor]:
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", seed=seed)
    return Pipeline(stages=[assembler(features), rf]), rf


@contextlib.contextmanager
def training_cache(df: DataFrame, task_rows: int = TASK_ROWS) -> Iterator[DataFrame]:
    """``df`` cached, in partitions that are worth their tasks.

    A search runs hundreds of stages over the frame, each with a task a partition,
    and a cached frame keeps those of the exchange it came from: as many as the whole
    input asked for, which the few rows left don't fill.  Such a frame is dealt out
    anew by its number of rows, and sorted, so that seeded folds and samples are alike
    in every run.  One of up to two partitions a core is left as it is.
    """
    cached = df.persist()
    try:
        want = max(1, -(-cached.count() // task_rows))
        if cached.rdd.getNumPartitions() > max(want, 2 * df.sparkSession.sparkContext.defaultParallelism):
            dealt = cached.repartition(want).sortWithinPartitions(*default_tie_break(df, [])).persist()
            try:
                dealt.count()
                cached.unpersist()
                yield dealt
            finally:
                dealt.unpersist()
        else:
            yield cached
    finally:
        cached.unpersist()


def train(
    train_df: DataFrame,
    grid: dict[str, list] | None = None,
    folds: int = REFERENCE_FOLDS,
    seed: int = SEED,
    label: str = TARGET,
    parallelism: int | None = None,
    fold_col: str | None = None,
) -> CrossValidatorModel:
    """Cross-validated random forest over ``grid`` (default: the reference's 2x2 grid).

    Folds are random (seeded) as in the reference; pass ``fold_col`` (e.g.
    from ``split.time_folds(df, k)``, with ``folds=k``) for time-blocked folds.

    The training frame is cached for the duration of the search (``training_cache``):
    every fold fit re-reads it, and recomputing the feature chain per fit is the cost
    the reference pays.
    """
    grid = REFERENCE_GRID if grid is None else grid
    drop = [label] + ([fold_col] if fold_col else [])
    feats = feature_columns(train_df.drop(*drop))
    pipe, rf = build_pipeline(feats, label, seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(rf.getParam(name), values)
    maps = builder.build()
    cv = CrossValidator(
        estimator=pipe,
        estimatorParamMaps=maps,
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
        numFolds=folds,
        seed=seed,
        # Fits of different grid points run concurrently (each is itself distributed).
        parallelism=parallelism or min(4, len(maps)),
        **({"foldCol": fold_col} if fold_col else {}),
    )
    with training_cache(train_df) as cached:
        return cv.fit(cached)


def train_forward(
    train_df: DataFrame,
    grid: dict[str, list] | None = None,
    folds: int = REFERENCE_FOLDS,
    seed: int = SEED,
    label: str = TARGET,
    time: str = "ts",
    parallelism: int | None = None,
) -> CrossValidatorModel:
    """``train`` with forward chaining: each fold learns from the past and is scored on the block that follows.

    Returns the same kind of model, its ``avgMetrics`` the mean RMSE of each grid
    point over the folds; the best one is fitted on all rows.
    """
    grid = REFERENCE_GRID if grid is None else grid
    feats = feature_columns(train_df.drop(label))
    pipe, rf = build_pipeline(feats, label, seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(rf.getParam(name), values)
    maps = builder.build()
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    with training_cache(train_df) as cached:
        errors: list[list[float]] = [[] for _ in maps]
        with ThreadPoolExecutor(parallelism or min(4, len(maps))) as pool:
            for past, block in forward_folds(cached, folds, time):
                found = pool.map(lambda m, past=past, block=block: evaluator.evaluate(pipe.fit(past, m).transform(block)), maps)
                for per_map, error in zip(errors, found, strict=True):
                    per_map.append(error)
        means = [sum(e) / len(e) for e in errors]
        best = pipe.fit(cached, maps[means.index(min(means))])
    search = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=evaluator, numFolds=max(2, folds), seed=seed)
    return search._copyValues(CrossValidatorModel(best, avgMetrics=means))


def best_pipeline(model) -> PipelineModel:
    return model.bestModel if isinstance(model, CrossValidatorModel) else model


def score(model, df: DataFrame) -> DataFrame:
    return best_pipeline(model).transform(df)


def rmse_value(scored: DataFrame, label: str = TARGET, pred: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=pred, metricName="rmse").evaluate(scored)


def rmse(df: DataFrame, label: str = TARGET, pred: str = "prediction", exact_cents: bool = False) -> DataFrame:
    """RMSE as a one-row frame (rows with a null on either side ignored).

    ``exact_cents`` squares integer cent differences, so the sum is exact and
    the value does not depend on how rows are spread over tasks.
    """
    both = df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
    if exact_cents:
        d = F.round(F.col(pred) * 100).cast("long") - F.round(F.col(label) * 100).cast("long")
        agg = both.agg(F.sum(d * d).alias("_ss"), F.count(F.lit(1)).alias("n"))
        return agg.select(
            (F.sqrt(F.col("_ss").cast("double") / F.col("n")) / 100).alias("rmse"), "n"
        )
    d = F.col(pred) - F.col(label)
    return both.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def feature_importance(model, min_score: float = 0.005) -> DataFrame:
    """(feature, importance) above ``min_score``, largest first.

    Built from the fitted model's importance vector: one value per feature,
    so its size is bounded by the feature count.
    """
    pm = best_pipeline(model)
    names = pm.stages[0].getInputCols()
    scores = pm.stages[-1].featureImportances.toArray().tolist()
    rows = [(n, float(s)) for n, s in zip(names, scores)]
    df = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return df.where(F.col("importance") > min_score).orderBy(F.col("importance").desc())


def save_model(model, path: str) -> None:
    best_pipeline(model).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """Load a saved pipeline; ``None`` when the path isn't there.  A broken model raises."""
    spark = SparkSession.getActiveSession()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return PipelineModel.load(path)
