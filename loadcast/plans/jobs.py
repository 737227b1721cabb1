"""End-to-end jobs: the batch layer's entry points, composed from the operators.

  clean_weather_file     raw weather CSV -> clean CSV           (cleaning step)
  csv_to_parquet         load/weather CSV -> Snappy Parquet     (conversion step)
  build_training_table   load + weather -> feature table        (feature views + CTAS)
  run_model_training     feature table -> split, CV, RMSE, importances, saved model
  run_prediction         saved model + history -> next hours, appended per run
  export_predictions     predictions -> latest n rows keyed for serving
  compact_log            stream or export log -> snapshots by day, a new manifest version
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loadcast.ml import model as ML
from loadcast.operators import compaction as CP
from loadcast.operators import kv as KV
from loadcast.operators import selection as SE
from loadcast.operators import split as SP
from loadcast.operators.features import final_features, join_raw
from loadcast.plans import forecast as FC
from loadcast.schemas import KEY, LOAD, WEATHER
from loadcast.session import scratch_scope
from loadcast.sources import files as FI
from loadcast.streaming import ingest as IN

#: Key, sequence and cells of each kind of keyed log.
LOGS = {
    "load": ("key", "seq", IN.load_cells()),
    "weather": ("key", "seq", IN.weather_cells()),
    "predictions": ("row_key", None, ["prediction_value", "prediction_ts"]),
}


def clean_weather_file(spark: SparkSession, input_path: str, output_path: str, on_error: str = "raise") -> int:
    """Raw weather CSV -> clean CSV sorted by time; returns rows written.

    With ``on_error="quarantine"`` bad rows go to ``output_path + "_rejected"``.
    """
    raw = FI.read_raw_weather_csv(spark, input_path)
    if on_error == "quarantine":
        good, bad = FI.clean_weather(raw, on_error="quarantine")
        bad.write.mode("errorifexists").option("header", True).csv(output_path.rstrip("/") + "_rejected")
    else:
        good = FI.clean_weather(raw, on_error="raise")
    FI.write_series_csv(good, output_path, order=KEY)
    return spark.read.option("header", True).csv(output_path).count()


def csv_to_parquet(
    spark: SparkSession, load_csv: str, weather_csv: str, load_parquet: str, weather_parquet: str
) -> tuple[int, int]:
    """Typed, strict CSV -> Snappy Parquet for both series; returns (load rows, weather rows)."""
    n_load = FI.write_series_parquet(FI.read_series_csv(spark, load_csv, LOAD), load_parquet)
    n_weather = FI.write_series_parquet(FI.read_series_csv(spark, weather_csv, WEATHER), weather_parquet)
    return n_load, n_weather


def build_training_table(load: DataFrame, weather: DataFrame, table: str, path: str, **window_opts) -> DataFrame:
    """The feature chain persisted as a Parquet table (fails if it exists).

    The row-numbering table the windows need is removed once the table is written.
    """
    spark = load.sparkSession
    with scratch_scope(spark):
        FI.training_table(final_features(load, weather, **window_opts), table, path)
    return spark.table(table)


@dataclass
class TrainingResult:
    model: object
    rmse: float
    bounds: DataFrame
    importances: DataFrame
    n_features: int


def run_model_training(
    features: DataFrame,
    model_path: str | None = None,
    ratio: float = 0.8,
    grid: dict | None = None,
    folds: int = ML.REFERENCE_FOLDS,
    min_importance: float = 0.005,
    forward: bool = False,
) -> TrainingResult:
    """Split in time order, cross-validate the forest, score the hold-out, save.

    ``forward``: folds that learn from the past only, instead of random ones.
    """
    df = features.drop(KEY) if KEY in features.columns else features
    train, test = SE.select_split(df, ratio)
    bounds = SP.assert_split_ordered(train, test)
    bounds = df.sparkSession.createDataFrame([bounds.first()], bounds.schema)  # one row
    model = (ML.train_forward if forward else ML.train)(train, grid=grid, folds=folds)
    rmse = ML.rmse_value(ML.score(model, test))
    if model_path:
        ML.save_model(model, model_path)
    n_features = len(ML.best_pipeline(model).stages[0].getInputCols())
    return TrainingResult(model, rmse, bounds, ML.feature_importance(model, min_importance), n_features)


def run_prediction(
    spark: SparkSession,
    model_path: str,
    load: DataFrame,
    weather: DataFrame,
    predictions_path: str | None = None,
    run_id: str | None = None,
    start: dt.datetime | str | None = None,
    hours: int = FC.HOURS,
) -> DataFrame | None:
    """Score the next ``hours`` hours; append them as partition ``run_id``.

    Returns None (and writes nothing) when no model can be loaded.
    """
    model = ML.load_model(model_path)
    if model is None:
        return None
    preds = FC.forecast(model, FC.forecast_inputs(join_raw(load, weather), start=start, hours=hours))
    if predictions_path:
        run = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
        FC.append_predictions(preds, predictions_path, run)
        return spark.read.parquet(predictions_path)
    return preds


def export_predictions(predictions: DataFrame, n: int = 24, zone: str | None = None) -> DataFrame:
    """Latest ``n`` predictions as (row_key, prediction_value, prediction_ts)."""
    kw = {"zone": zone} if zone else {}
    return KV.export_latest(predictions, n=n, **kw)


def compact_log(spark: SparkSession, kind: str, log_path: str, grace_s: float = 86_400) -> CP.Manifest:
    """Fold the batches of a log (see ``LOGS``) that came since its last compaction."""
    key, seq, cells = LOGS[kind]
    return CP.compact(spark, log_path, key, seq, cells, grace_s)


def current_table(spark: SparkSession, kind: str, log_path: str) -> DataFrame:
    """The current rows of a log (see ``LOGS``), compacted or not, with their day."""
    key, seq, cells = LOGS[kind]
    return CP.read_current(spark, log_path, key, seq, cells)
