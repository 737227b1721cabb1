"""Query catalogue: every implemented operator as (spark, sf_dir) -> DataFrame,
with the DuckDB SQL that must give the same rows.

Each query reads the driver's tables (``events`` mostly, through the
adapters) so its work grows with the data.  Queries that write intermediate
tables (CSV/Parquet round trips, stream logs, models) write below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.ml import model as ML
from loadcast.operators import appending as AP
from loadcast.operators import bucketed as BU
from loadcast.operators import compaction as CP
from loadcast.operators import features as FE
from loadcast.operators import kv as KV
from loadcast.operators import selection as SE
from loadcast.operators import split as SP
from loadcast.plans import forecast as FC
from loadcast.plans import oracle as O
from loadcast.plans import serving as SV
from loadcast.schemas import KEY, LOAD, WEATHER
from loadcast.session import ensure_checkpoint_root, scratch_path
from loadcast.sources import adapters as AD
from loadcast.sources import files as FI
from loadcast.streaming import control as CO
from loadcast.streaming import expiring as EX
from loadcast.streaming import ingest as IN
from loadcast.streaming import live as LI

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_root(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


# The adapters' values are exact cents, so averages can be exact sums of cents.
CENTS = 2


def _series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = AD.read_table(spark, sf_dir, "events")
    return AD.load_series(ev), AD.weather_series(ev)


@register("final_features", O.with_ctes(*O.FEATURE_CTES) + " SELECT * FROM final_features")
def q_final_features(spark, sf_dir):
    """Flagship: join, calendar, weather and row-window features, warm-up filtered."""
    load, weather = _series(spark, sf_dir)
    return FE.final_features(load, weather, avg_scale=CENTS)


# ------------------------------------------------------------------ feature chain pieces


def _joined(spark, sf_dir):
    load, weather = _series(spark, sf_dir)
    return FE.join_raw(load, weather)


def _features_weather(spark, sf_dir):
    return FE.weather_features(FE.time_features(_joined(spark, sf_dir)))


@register("joined_raw", O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE) + " SELECT * FROM joined_raw")
def q_joined_raw(spark, sf_dir):
    """J1 + P5: load LEFT JOIN weather on the key, ts parsed leniently."""
    return _joined(spark, sf_dir)


@register(
    "features_time",
    O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE, O.TIME_CTE) + " SELECT * FROM features_time",
)
def q_features_time(spark, sf_dir):
    """P6-P10: hour, day of week (1 = Sunday), month, year, weekend flag."""
    return FE.time_features(_joined(spark, sf_dir))


@register(
    "features_weather",
    O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE, O.TIME_CTE, O.WEATHER_FEAT_CTE)
    + " SELECT * FROM features_weather",
)
def q_features_weather(spark, sf_dir):
    """P11-P13: TEMP squared, rain flag, humidity x temperature."""
    return _features_weather(spark, sf_dir)


_WINDOWED_SQL = O.with_ctes(*O.FEATURE_CTES)


def _windowed(spark, sf_dir):
    return FE.window_features(_joined(spark, sf_dir), warmup_filter=False, avg_scale=CENTS)


@register(
    "lag_features",
    _WINDOWED_SQL + f" SELECT {KEY}, load_lag_1h, load_lag_24h, load_lag_7d, temp_lag_2h FROM windowed",
)
def q_lag_features(spark, sf_dir):
    """W1-W4 over every row (no warm-up filter): lags count rows, not hours."""
    return _windowed(spark, sf_dir).select(KEY, "load_lag_1h", "load_lag_24h", "load_lag_7d", "temp_lag_2h")


@register("temp_change", _WINDOWED_SQL + f" SELECT {KEY}, TEMP, temp_change_24h FROM windowed")
def q_temp_change(spark, sf_dir):
    """W5 + P14: TEMP minus TEMP 24 rows back."""
    return _windowed(spark, sf_dir).select(KEY, "TEMP", "temp_change_24h")


@register("load_moving_avg", _WINDOWED_SQL + f" SELECT {KEY}, mw, load_ma_7d FROM windowed")
def q_load_moving_avg(spark, sf_dir):
    """W6: 168-row trailing average including the current row."""
    return _windowed(spark, sf_dir).select(KEY, "mw", "load_ma_7d")


@register("halo_lag_events", O.event_lag_sql())
def q_halo_lag_events(spark, sf_dir):
    """Section 4.3 on every raw event: one global order (ts, event_id), halo blocks."""
    ev = AD.event_series(AD.read_table(spark, sf_dir, "events"))
    return FE.lag_profile(ev, order=("ts", "event_id"), block=8192, avg_scale=CENTS)


@register("halo_lag_events_by_user", O.event_lag_sql("user_id"))
def q_halo_lag_events_by_user(spark, sf_dir):
    """Many series at once (series_keys=user_id); hot users are split into blocks."""
    ev = AD.event_series(AD.read_table(spark, sf_dir, "events"))
    return FE.lag_profile(ev, order=("ts", "event_id"), series_keys=("user_id",), block=8192, avg_scale=CENTS)


# ------------------------------------------------------------------ ingest and tables


@register(
    "clean_weather",
    O.with_ctes(O.WEATHER_CTE)
    + " SELECT make_timestamp(CAST(year(t) AS BIGINT), CAST(month(t) AS BIGINT), CAST(day(t) AS BIGINT),"
    " CAST(hour(t) AS BIGINT), 0, 0) AS datetime_ept, TEMP, PRCP, HMDT, WND_SPD, ATM_PRESS"
    " FROM (SELECT CAST(datetime_ept AS TIMESTAMP) AS t, * FROM weather_data)",
)
def q_clean_weather(spark, sf_dir):
    """S1 + P1-P3 + K1: raw YEAR/MO/DY/HR CSV written, read by header, cleaned strictly."""
    _, weather = _series(spark, sf_dir)
    path = scratch_path(spark, "raw-weather-csv")
    FI.write_series_csv(AD.raw_weather(weather), path, order=None)
    return FI.clean_weather(FI.read_raw_weather_csv(spark, path), on_error="raise")


def _roundtrip(spark, df, schema, label):
    csv_path = scratch_path(spark, f"{label}-csv")
    pq_path = scratch_path(spark, f"{label}-parquet")
    FI.write_series_csv(df, csv_path)
    typed = FI.read_series_csv(spark, csv_path, schema, on_error="raise")
    FI.write_series_parquet(typed, pq_path)
    name = f"{label}_data_{uuid.uuid4().hex[:8]}"
    return FI.external_table(spark, name, pq_path, schema, temporary=True)


@register("csv_parquet_load", O.with_ctes(O.LOAD_CTE) + " SELECT * FROM load_data")
def q_csv_parquet_load(spark, sf_dir):
    """S2 + P4 + K1 + K2 + S4: load CSV -> strict typed read -> Snappy Parquet -> external table."""
    load, _ = _series(spark, sf_dir)
    return _roundtrip(spark, load, LOAD, "load")


@register("csv_parquet_weather", O.with_ctes(O.WEATHER_CTE) + " SELECT * FROM weather_data")
def q_csv_parquet_weather(spark, sf_dir):
    """S3 + P4 + K1 + K2 + S4 for the weather series."""
    _, weather = _series(spark, sf_dir)
    return _roundtrip(spark, weather, WEATHER, "weather")


@register("training_table", O.with_ctes(*O.FEATURE_CTES) + " SELECT * FROM final_features")
def q_training_table(spark, sf_dir):
    """K3 + S5: the feature set persisted as a Parquet table, read back by name."""
    feats = q_final_features(spark, sf_dir)
    name = f"final_training_features_{uuid.uuid4().hex[:8]}"
    table = FI.training_table(feats, name, scratch_path(spark, "training-table"))
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay until the scratch folder goes
    return table


# ------------------------------------------------------------------ split


def _model_frame(spark, sf_dir):
    """Training input as the reference builds it: feature table without the key string."""
    return q_final_features(spark, sf_dir).drop(KEY)


def _numbered_frame(spark, sf_dir):
    """``_model_frame`` with the row number (``rn``) that its windows were computed over."""
    load, weather = _series(spark, sf_dir)
    return FE.final_features(load, weather, avg_scale=CENTS, keep_rn=True).drop(KEY)


def _split(spark, sf_dir):
    return SP.time_split(_numbered_frame(spark, sf_dir), ratio=0.8, rn="rn")


_SPLIT_SQL = O.with_ctes(*O.SPLIT_CTES)


@register("split_train", _SPLIT_SQL + " SELECT * EXCLUDE (_rn) FROM numbered WHERE _rn < (SELECT c FROM cut)")
def q_split_train(spark, sf_dir):
    """O4: the first int(0.8 n) rows in time order."""
    return _split(spark, sf_dir)[0]


@register("split_test", _SPLIT_SQL + " SELECT * EXCLUDE (_rn) FROM numbered WHERE _rn >= (SELECT c FROM cut)")
def q_split_test(spark, sf_dir):
    """X1: the remaining rows."""
    return _split(spark, sf_dir)[1]


@register(
    "split_bounds",
    _SPLIT_SQL
    + """
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE _rn < (SELECT c FROM cut)) AS train_rows,
       count(*) FILTER (WHERE _rn >= (SELECT c FROM cut)) AS test_rows,
       max(ts) FILTER (WHERE _rn < (SELECT c FROM cut)) AS train_max_ts,
       min(ts) FILTER (WHERE _rn >= (SELECT c FROM cut)) AS test_min_ts,
       coalesce(max(ts) FILTER (WHERE _rn < (SELECT c FROM cut))
                <= min(ts) FILTER (WHERE _rn >= (SELECT c FROM cut)), true) AS ordered
FROM numbered""",
)
def q_split_bounds(spark, sf_dir):
    """A1 + A2: sizes and boundary timestamps of the split, and their order check."""
    return SP.time_split_with_bounds(_numbered_frame(spark, sf_dir), ratio=0.8, rn="rn")[2]


@register("split_except_all", _SPLIT_SQL + " SELECT * EXCLUDE (_rn) FROM numbered WHERE _rn >= (SELECT c FROM cut)")
def q_split_except_all(spark, sf_dir):
    """X1 as the reference computes it: all rows EXCEPT ALL the train rows."""
    df = _numbered_frame(spark, sf_dir)
    train, _ = SP.time_split(df, ratio=0.8, rn="rn")
    return SP.test_by_except_all(df.drop("rn"), train)


def _stored_frame(spark, sf_dir):
    """The training table as a job reads it back: files, without a row number."""
    path = scratch_path(spark, "features")
    FI.write_series_parquet(_model_frame(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("split_selected_train", _SPLIT_SQL + " SELECT * EXCLUDE (_rn) FROM numbered WHERE _rn < (SELECT c FROM cut)")
def q_split_selected_train(spark, sf_dir):
    """O4 by selection: the cut of a stored table found by histograms; no sort of the table, no numbered copy."""
    return SE.select_split(_stored_frame(spark, sf_dir))[0]


@register("split_selected_test", _SPLIT_SQL + " SELECT * EXCLUDE (_rn) FROM numbered WHERE _rn >= (SELECT c FROM cut)")
def q_split_selected_test(spark, sf_dir):
    """X1 by selection."""
    return SE.select_split(_stored_frame(spark, sf_dir))[1]


@register(
    "split_selected_ties",
    """
WITH e AS (
  SELECT event_id, date_trunc('day', ts) AS ts, event_type FROM events
  UNION ALL SELECT -1, TIMESTAMP '2024-01-12 00:00:00', 'copy' FROM events
), n AS (SELECT *, row_number() OVER (ORDER BY ts, event_type = 'copy') - 1 AS i, CAST(floor(0.5 * count(*) OVER ()) AS BIGINT) AS c FROM e)
SELECT any_value(c) AS train_rows, count(*) - any_value(c) AS test_rows, max(ts) FILTER (WHERE i < c) AS train_max_ts,
       min(ts) FILTER (WHERE i >= c) AS test_min_ts, count(*) FILTER (WHERE event_type = 'copy') AS copies, count(*) - count(*) FILTER (WHERE event_type = 'copy') AS events
FROM n""",
)
def q_split_selected_ties(spark, sf_dir):
    """O4 by selection where times repeat: days, and half of all rows the same row over; each event is on one side once."""
    ev = AD.read_table(spark, sf_dir, "events")
    days = ev.select("event_id", F.to_date("ts").cast("timestamp_ntz").alias("ts"), "event_type")
    same = ev.select(F.lit(-1).cast("long").alias("event_id"), F.lit("2024-01-12 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit("copy").alias("event_type"))
    train, test = SE.select_split(days.unionByName(same), 0.5)
    both = train.withColumn("_late", F.lit(False)).unionByName(test.withColumn("_late", F.lit(True)))
    is_copy = F.col("event_type") == "copy"
    return both.agg(
        F.count_if(~F.col("_late")).alias("train_rows"), F.count_if("_late").alias("test_rows"),
        F.max(F.when(~F.col("_late"), F.col("ts"))).alias("train_max_ts"), F.min(F.when(F.col("_late"), F.col("ts"))).alias("test_min_ts"),
        F.count_if(is_copy).alias("copies"), F.count_distinct(F.when(~is_copy, F.col("event_id"))).alias("events"),
    )


@register(
    "forward_folds",
    _SPLIT_SQL
    + """,
total AS (SELECT count(*) AS n FROM numbered),
folds AS (SELECT f, CAST(floor(f * n / 4) AS BIGINT) AS a, CAST(CASE WHEN f = 3 THEN n ELSE floor((f + 1) * n / 4) END AS BIGINT) AS b FROM total, unnest([1, 2, 3]) AS t(f))
SELECT CAST(f - 1 AS INTEGER) AS fold, count(*) FILTER (WHERE _rn < a) AS train_rows, max(ts) FILTER (WHERE _rn < a) AS train_max_ts,
       count(*) FILTER (WHERE _rn >= a) AS validate_rows, min(ts) FILTER (WHERE _rn >= a) AS validate_min_ts, max(ts) FILTER (WHERE _rn >= a) AS validate_max_ts
FROM folds JOIN numbered ON _rn < b GROUP BY f""",
)
def q_forward_folds(spark, sf_dir):
    """M5 + D22: folds that learn from the past and are checked on the block that follows."""
    out = None
    for i, (past, block) in enumerate(SE.forward_folds(_stored_frame(spark, sf_dir), 3)):
        both = past.select("ts", F.lit(True).alias("_past")).unionByName(block.select("ts", F.lit(False).alias("_past")))
        learned, checked = F.when(F.col("_past"), F.col("ts")), F.when(~F.col("_past"), F.col("ts"))
        one = both.agg(
            F.lit(i).alias("fold"), F.count_if("_past").alias("train_rows"), F.max(learned).alias("train_max_ts"),
            F.count_if(~F.col("_past")).alias("validate_rows"), F.min(checked).alias("validate_min_ts"), F.max(checked).alias("validate_max_ts"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ model


_NOT_NULL_19 = " AND ".join(f"{c} IS NOT NULL" for c in O.FEATURE_COLS_19)


@register(
    "assembler_rows",
    O.with_ctes(*O.FEATURE_CTES) + f" SELECT * EXCLUDE ({KEY}) FROM final_features WHERE {_NOT_NULL_19}",
)
def q_assembler_rows(spark, sf_dir):
    """M1: rows that survive the 19-feature assembler's null skip (vector dropped)."""
    df = _model_frame(spark, sf_dir)
    feats = ML.feature_columns(df)
    assert len(feats) == 19, feats
    return ML.assembled_rows(df, feats)


@register(
    "rmse_seasonal",
    _SPLIT_SQL
    + """
SELECT sqrt(CAST(sum(d * d) AS DOUBLE) / count(*)) / 100 AS rmse, count(*) AS n
FROM (SELECT CAST(round(load_lag_24h * 100) AS BIGINT) - CAST(round(mw * 100) AS BIGINT) AS d
      FROM numbered WHERE _rn >= (SELECT c FROM cut) AND mw IS NOT NULL AND load_lag_24h IS NOT NULL)""",
)
def q_rmse_seasonal(spark, sf_dir):
    """A3 on the test split with yesterday's load as the prediction (exact in cents)."""
    _, test = _split(spark, sf_dir)
    return ML.rmse(test, label="mw", pred="load_lag_24h", exact_cents=True)


def _trained(spark, sf_dir):
    """The reference's full grid search."""
    train, test = _split(spark, sf_dir)
    return ML.train(train), train, test


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """M2-M6 + A3: cross-validated forest, hold-out RMSE and sizes (rows-only check)."""
    model, train, test = _trained(spark, sf_dir)
    scored = ML.score(model, test)
    return ML.rmse(scored, label="mw", pred="prediction").select(
        "rmse",
        F.col("n").alias("n_test_scored"),
        F.lit(len(ML.feature_columns(train.drop("mw")))).alias("n_features"),
    )


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """O5: importances above 0.005, largest first (rows-only check)."""
    model, _, _ = _trained(spark, sf_dir)
    return ML.feature_importance(model, 0.005)


@register("model_reload_scores")
def q_model_reload_scores(spark, sf_dir):
    """K8 + S8 + M6: save the best pipeline, load it back, score the test rows."""
    model, _, test = _trained(spark, sf_dir)
    path = scratch_path(spark, "model")
    ML.save_model(model, path)
    loaded = ML.load_model(path)
    return ML.score(loaded, test).select("ts", "mw", "prediction")


# ------------------------------------------------------------------ forecast and export


_FC_COLS = ", ".join([KEY, "ts", "mw", *O.FEATURE_COLS_19])


@register(
    "forecast_inputs",
    O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE, O.FORECAST_CTE)
    + f" SELECT {_FC_COLS} FROM fc WHERE _future",
)
def q_forecast_inputs(spark, sf_dir):
    """M7 + P17 + S7: 24 future hours with all features, unknowns filled."""
    return FC.forecast_inputs(_joined(spark, sf_dir), avg_scale=CENTS).select(*[c.strip() for c in _FC_COLS.split(",")])


@register("forecast_24h")
def q_forecast_24h(spark, sf_dir):
    """M6 + P18: the trained model scores the 24 forecast rows (rows-only check)."""
    model, _, _ = _trained(spark, sf_dir)
    return FC.forecast(model, FC.forecast_inputs(_joined(spark, sf_dir), avg_scale=CENTS))


def _seasonal_preds(spark, sf_dir):
    return FC.seasonal_predictions(q_final_features(spark, sf_dir))


@register(
    "export_latest_24",
    O.with_ctes(*O.FEATURE_CTES, O.PRED_KV_CTE)
    + " SELECT row_key, prediction_value, prediction_ts FROM pred_kv"
    " ORDER BY row_key DESC, prediction_value DESC LIMIT 24",
)
def q_export_latest_24(spark, sf_dir):
    """K6 + O3 + P19 + P20: the latest 24 predictions as key, value, epoch seconds."""
    return KV.export_latest(_seasonal_preds(spark, sf_dir), n=24)


# ------------------------------------------------------------------ keyed tables and stream


@register(
    "kv_cells",
    O.with_ctes(O.UPSERT_CTE)
    + """
SELECT key, seq, 'value' AS "column", CAST(value AS VARCHAR) AS value FROM upserts WHERE value IS NOT NULL
UNION ALL
SELECT key, seq, 'props', props FROM upserts WHERE props IS NOT NULL""",
)
def q_kv_cells(spark, sf_dir):
    """P26: wide rows to (key, seq, column, value) cells, null cells omitted."""
    ups = AD.keyed_upserts(AD.read_table(spark, sf_dir, "events"))
    return KV.kv_cells(ups, "key", "seq", ["value", "props"])


@register(
    "kv_current",
    O.with_ctes(O.UPSERT_CTE)
    + """
SELECT key, max(seq) AS seq,
       max_by(value, seq) FILTER (WHERE value IS NOT NULL) AS value,
       max_by(props, seq) FILTER (WHERE props IS NOT NULL) AS props
FROM upserts GROUP BY key""",
)
def q_kv_current(spark, sf_dir):
    """K7 merge: per key, each cell's latest non-null value (older cells survive nulls)."""
    ups = AD.keyed_upserts(AD.read_table(spark, sf_dir, "events"))
    return KV.kv_current(ups, "key", ("seq",), ["value", "props"])


def _run_stream(spark, sf_dir, messages_fn, schema, key, cells):
    events_schema = AD.read_table(spark, sf_dir, "events").schema
    src = IN.file_message_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", events_schema, max_files=100)
    parsed = IN.parse_readings(messages_fn(src), schema, key)
    log_path = scratch_path(spark, "kv-log")
    q = IN.start_ingest(parsed, log_path, scratch_path(spark, "stream-ckpt"), cells, trigger={"availableNow": True})
    IN.run_for(q)
    return KV.kv_current(KV.kv_read_log(spark, log_path), "key", (KV.BATCH, "seq"), cells, day=KV.DAY)


@register("stream_load", O.with_ctes(O.LOAD_MSG_CTE) + " SELECT * FROM load_kv")
def q_stream_load(spark, sf_dir):
    """S6 (file stream) + P21-P25 + T1-T8 + K7: JSON load readings to the keyed log, current view."""
    return _load_stream(spark, sf_dir).drop(KV.DAY)


def _load_stream(spark, sf_dir):
    return _run_stream(spark, sf_dir, IN.load_messages, IN.LOAD_SCHEMA, "timestamp", IN.load_cells())


def _weather_stream(spark, sf_dir):
    return _run_stream(spark, sf_dir, IN.weather_messages, IN.WEATHER_SCHEMA, KEY, IN.weather_cells())


@register("stream_weather", O.with_ctes(O.WEATHER_MSG_CTE) + " SELECT * FROM weather_kv")
def q_stream_weather(spark, sf_dir):
    """The same for weather readings (lower-case measure names)."""
    return _weather_stream(spark, sf_dir).drop(KV.DAY)


# ------------------------------------------------------------------ serving


# Whole key space: the endpoints' range scan over every stored hour.
ALL_START, ALL_STOP = "0000-01-01 00:00:00", "9999-12-31 23:59:59"


def _batch_kv(spark, sf_dir, messages_fn, schema, key, cells):
    """The keyed table the stream would build, computed in batch from the same messages."""
    ev = AD.read_table(spark, sf_dir, "events")
    parsed = IN.parse_readings(messages_fn(ev), schema, key).where(~F.col("rejected"))
    log = parsed.select("key", "seq", *cells).withColumn(KV.BATCH, F.lit(0))
    return KV.kv_current(log, "key", (KV.BATCH, "seq"), cells)


def _load_kv(spark, sf_dir):
    return _batch_kv(spark, sf_dir, IN.load_messages, IN.LOAD_SCHEMA, "timestamp", IN.load_cells())


def _weather_kv(spark, sf_dir):
    return _batch_kv(spark, sf_dir, IN.weather_messages, IN.WEATHER_SCHEMA, KEY, IN.weather_cells())


def _pred_kv(spark, sf_dir):
    return SV.predictions_kv(_seasonal_preds(spark, sf_dir))


@register(
    "serve_predictions",
    O.with_ctes(*O.FEATURE_CTES, O.PRED_KV_CTE)
    + " SELECT row_key AS datetime, prediction_ts AS timestamp, prediction_value AS predictedLoad FROM pred_kv",
)
def q_serve_predictions(spark, sf_dir):
    """V1 + S10 + P27 + P29: forecast rows of a key range."""
    return SV.predictions(_pred_kv(spark, sf_dir), ALL_START, ALL_STOP)


@register(
    "serve_actual",
    O.with_ctes(O.LOAD_MSG_CTE)
    + " SELECT key AS datetime, timestamp_ms AS timestamp, current_reading AS actualLoad FROM load_kv",
)
def q_serve_actual(spark, sf_dir):
    """V2: actual load of a key range."""
    return SV.actual_load(_load_kv(spark, sf_dir), ALL_START, ALL_STOP)


@register(
    "serve_weather",
    O.with_ctes(O.WEATHER_MSG_CTE)
    + " SELECT key AS datetime, temp AS temperature, hmdt AS humidity, atm_press AS pressure,"
    " wnd_spd AS windSpeed, prcp AS precipitation FROM weather_kv",
)
def q_serve_weather(spark, sf_dir):
    """V3: weather of a key range."""
    return SV.weather(_weather_kv(spark, sf_dir), ALL_START, ALL_STOP)


_COMBINED_SQL = O.with_ctes(*O.FEATURE_CTES, O.PRED_KV_CTE, O.LOAD_MSG_CTE, O.WEATHER_MSG_CTE, O.COMBINED_CTE)


def _combined(spark, sf_dir):
    return SV.combined(_pred_kv(spark, sf_dir), _load_kv(spark, sf_dir), _weather_kv(spark, sf_dir))


@register("serve_combined", _COMBINED_SQL + " SELECT * FROM combined")
def q_serve_combined(spark, sf_dir):
    """V4 + J2 + P28: forecast, actual, absolute error and weather per forecast hour."""
    return _combined(spark, sf_dir)


@register("serve_combined_bucketed", _COMBINED_SQL + " SELECT * FROM combined")
def q_serve_combined_bucketed(spark, sf_dir):
    """J2 without a shuffle: the three keyed tables stored in buckets of their key, merge-joined bucket by bucket."""
    tables = {"row_key": _pred_kv(spark, sf_dir), "load": _load_kv(spark, sf_dir), "weather": _weather_kv(spark, sf_dir)}
    buckets = max(BU.bucket_count(t) for t in tables.values())
    stored = []
    for label, kv in tables.items():
        name = f"kv_{label}_{uuid.uuid4().hex[:8]}"
        stored.append(BU.write_buckets(kv, name, scratch_path(spark, f"buckets-{label}"), buckets, "row_key" if label == "row_key" else "key"))
        spark.sql(f"DROP TABLE {name}")  # the name only
    return SV.combined(*stored, join="merge")


@register(
    "dashboard_rows",
    _COMBINED_SQL
    + """
SELECT datetime, split_part(datetime, ' ', 2) AS time,
       CASE WHEN predicted IS NULL THEN 'N/A' ELSE printf('%.2f', predicted) END AS predicted,
       CASE WHEN actual IS NULL THEN 'N/A' ELSE printf('%.2f', actual) END AS actual,
       CASE WHEN error IS NULL THEN 'N/A' ELSE printf('%.2f', error) END AS error,
       CASE WHEN temp IS NULL THEN 'N/A' ELSE printf('%.2f', temp) END AS temperature,
       CASE WHEN humidity IS NULL THEN 'N/A' ELSE printf('%.2f', humidity) END AS humidity
FROM combined""",
)
def q_dashboard_rows(spark, sf_dir):
    """V5 + P31: dashboard table text, N/A only for missing values."""
    return SV.dashboard(_combined(spark, sf_dir))


# ------------------------------------------------------------------ extras: preview, dense hours


@register(
    "preview_joined",
    O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE) + " SELECT * FROM joined_raw ORDER BY ts NULLS FIRST LIMIT 5",
)
def q_preview_joined(spark, sf_dir):
    """O2 + K9: the first five joined rows in time order (the limit is the feature)."""
    return SP.first_rows(_joined(spark, sf_dir), 5)


@register(
    "final_features_dense",
    O.with_ctes(*O.FEATURE_CTES, O.DENSE_CTE)
    + " SELECT * EXCLUDE (_filler) FROM dense_windowed WHERE NOT _filler AND load_lag_7d IS NOT NULL",
)
def q_final_features_dense(spark, sf_dir):
    """D1 extra: missing hours filled before the windows, so lags count hours."""
    load, weather = _series(spark, sf_dir)
    return FE.final_features(load, weather, densify=True, avg_scale=CENTS)


@register("views_final_features", O.with_ctes(*O.FEATURE_CTES) + " SELECT * FROM final_features")
def q_views_final_features(spark, sf_dir):
    """K4: the four chained views registered by name and queried with Spark SQL."""
    load, weather = _series(spark, sf_dir)
    prefix = f"v{uuid.uuid4().hex[:8]}_"
    FE.register_views(spark, load, weather, prefix=prefix, avg_scale=CENTS)
    return spark.sql(f"SELECT * FROM {prefix}final_features")


@register("lag_features_by_user", O.by_user_sql())
def q_lag_features_by_user(spark, sf_dir):
    """D2 extra: the whole feature chain over many series at once (one per user)."""
    ev = AD.read_table(spark, sf_dir, "events")
    keys = ("user_id",)
    feats = FE.final_features(
        AD.load_series(ev, keys), AD.weather_series(ev, keys), series_keys=keys, warmup_filter=False, avg_scale=CENTS
    )
    return feats.select(
        "user_id", KEY, "mw", "TEMP", "load_lag_1h", "load_lag_24h", "load_lag_7d",
        "temp_lag_2h", "temp_change_24h", "load_ma_7d",
    )


@register("features_appended", O.by_user_sql())
def q_features_appended(spark, sf_dir):
    """W1-W6 + P14 for appended hours: ten slices of time, each windowed against its series' last rows only."""
    ev = AD.read_table(spark, sf_dir, "events")
    keys = ("user_id",)
    joined = FE.join_raw(AD.load_series(ev, keys), AD.weather_series(ev, keys), series_keys=keys)
    path = scratch_path(spark, "joined-slices")
    place = F.least(F.expr("(dayofmonth(ts) - 1) div 3"), F.lit(9)).cast("int")
    joined.withColumn("slice", place).write.partitionBy("slice").parquet(path)
    out, state = scratch_path(spark, "appended"), scratch_path(spark, "appended-state")
    stored = spark.read.parquet(path)
    for i in range(10):
        AP.append_features(stored.where(F.col("slice") == i).select(*joined.columns), out, state, i, series_keys=keys, avg_scale=CENTS)
    return spark.read.parquet(out).select(
        "user_id", KEY, "mw", "TEMP", "load_lag_1h", "load_lag_24h", "load_lag_7d",
        "temp_lag_2h", "temp_change_24h", "load_ma_7d",
    )


@register(
    "assembler_split_rows",
    _SPLIT_SQL
    + f"""
SELECT count(*) FILTER (WHERE _rn < (SELECT c FROM cut) AND {_NOT_NULL_19}) AS train_rows_assembled,
       count(*) FILTER (WHERE _rn >= (SELECT c FROM cut) AND {_NOT_NULL_19}) AS test_rows_assembled,
       CAST(19 AS INTEGER) AS n_features
FROM numbered""",
)
def q_assembler_split_rows(spark, sf_dir):
    """M1 on the split: rows the model trains and is scored on, and the feature count."""
    marked = SP.mark_test(_numbered_frame(spark, sf_dir), ratio=0.8, rn="rn", flag="_test")
    feats = ML.feature_columns(marked.drop("mw", "_test"))
    return ML.assembled_rows(marked, feats).agg(
        F.count_if(~F.col("_test")).alias("train_rows_assembled"),
        F.count_if(F.col("_test")).alias("test_rows_assembled"),
        F.lit(len(feats)).alias("n_features"),
    )


@register("stream_load_stateful", O.with_ctes(O.LOAD_MSG_CTE) + " SELECT * FROM load_kv")
def q_stream_load_stateful(spark, sf_dir):
    """K7 as streaming state: the current row per key kept by a streaming aggregation."""
    events_schema = AD.read_table(spark, sf_dir, "events").schema
    src = IN.file_message_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", events_schema, max_files=100)
    parsed = IN.parse_readings(IN.load_messages(src), IN.LOAD_SCHEMA, "timestamp")
    out = scratch_path(spark, "kv-current")
    q = IN.start_current_view(parsed, out, scratch_path(spark, "state-ckpt"), IN.load_cells(), trigger={"availableNow": True})
    IN.run_for(q)
    return IN.read_current_view(spark, out, IN.load_cells())


# ------------------------------------------------------------------ averages of finer values


@register(
    "load_moving_avg_exact",
    """
SELECT event_id,
       CAST(sum(CAST(mw AS DECIMAL(18,4))) OVER w AS DOUBLE) / NULLIF(count(mw) OVER w, 0) AS ma_168,
       true AS default_agrees
FROM (SELECT event_id, ts, round(value / 7, 4) AS mw FROM events)
WINDOW w AS (ORDER BY ts NULLS FIRST, event_id NULLS FIRST ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)""",
)
def q_load_moving_avg_exact(spark, sf_dir):
    """W6 on values of four decimals: exact with avg_scale=4, and the default average agrees."""
    ev = AD.event_series(AD.read_table(spark, sf_dir, "events")).withColumn("mw", F.round(F.col("mw") / 7, 4))
    exact = FE.lag_profile(ev, lags=(1,), avg_scale=4, block=8192).select("event_id", "ma_168")
    plain = FE.lag_profile(ev, lags=(1,), block=8192).select("event_id", F.col("ma_168").alias("_plain"))
    agrees = (F.abs(F.col("ma_168") - F.col("_plain")) <= 1e-9) | (F.col("ma_168").isNull() & F.col("_plain").isNull())
    return exact.join(plain, "event_id").select("event_id", "ma_168", agrees.alias("default_agrees"))


# ------------------------------------------------------------------ forecast from a chosen start


def _forecast_from(spark, sf_dir, hours_after_last: int):
    joined = _joined(spark, sf_dir)
    start = joined.agg(F.max("ts") + F.make_interval(hours=F.lit(hours_after_last))).first()[0]  # one scalar
    inputs = FC.forecast_inputs(joined, start=start, avg_scale=CENTS)
    return inputs.select(*[c.strip() for c in _FC_COLS.split(",")])


def _forecast_sql(hours_after_last: int) -> str:
    start = f"SELECT max(ts) + INTERVAL ({hours_after_last}) HOUR FROM joined_raw"
    ctes = O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE, O.forecast_cte(start, max(24, hours_after_last + 23)))
    return ctes + f" SELECT {_FC_COLS} FROM fc WHERE _future"


@register("forecast_inputs_start_inside", _forecast_sql(-71))
def q_forecast_inputs_start_inside(spark, sf_dir):
    """M7 as a back-test: three days before the end, from history before the start alone."""
    return _forecast_from(spark, sf_dir, -71)


@register("forecast_inputs_gap", _forecast_sql(49))
def q_forecast_inputs_gap(spark, sf_dir):
    """M7 with 48 unknown hours between the history and the start."""
    return _forecast_from(spark, sf_dir, 49)


# ------------------------------------------------------------------ ranges and days


def _bounds(kv: DataFrame, key: str) -> tuple[str, str]:
    """First and last key: the range starts on a row that counts and stops on one that doesn't."""
    return tuple(kv.agg(F.min(key), F.max(key)).first())


_IN_RANGE = " WHERE datetime >= (SELECT min(datetime) FROM served) AND datetime < (SELECT max(datetime) FROM served)"


def _range_sql(name: str) -> str:
    return f"WITH served AS ({ORACLE_SQL[name]}) SELECT * FROM served{_IN_RANGE}"


@register("serve_predictions_range", _range_sql("serve_predictions"))
def q_serve_predictions_range(spark, sf_dir):
    """V1 + S10: start inclusive, stop exclusive, both on stored keys."""
    kv = _pred_kv(spark, sf_dir)
    return SV.predictions(kv, *_bounds(kv, "row_key"))


@register("serve_actual_range", _range_sql("serve_actual"))
def q_serve_actual_range(spark, sf_dir):
    """V2 + S10 + P27: the range over text cells, as a string-typed store holds them."""
    kv = _load_kv(spark, sf_dir)
    cells = KV.kv_cells(kv, "key", "seq", IN.load_cells())
    typed = KV.kv_from_cells(cells, {"timestamp_ms": "bigint", "current_reading": "double"})
    return SV.actual_load(typed, *_bounds(typed, "key"))


@register("serve_weather_range", _range_sql("serve_weather"))
def q_serve_weather_range(spark, sf_dir):
    """V3 + S10."""
    kv = _weather_kv(spark, sf_dir)
    return SV.weather(kv, *_bounds(kv, "key"))


_DAY_SQL = " WHERE substr(datetime, 1, 10) = (SELECT substr(max(datetime), 1, 10) FROM served)"


def _last_day(spark, sf_dir) -> tuple[DataFrame, str]:
    """The predictions as a table by day, and the last day predicted (any day, if none is)."""
    path = scratch_path(spark, "predictions-kv")
    KV.kv_write_by_day(_pred_kv(spark, sf_dir), path, key="row_key")
    kv = KV.kv_read_log(spark, path)
    return kv, (kv.agg(F.max("row_key")).first()[0] or ALL_START)[:10]


def _combined_day(spark, sf_dir):
    """The day's folders of the three tables are read: the readings' logs as the streams left them."""
    kv, day = _last_day(spark, sf_dir)
    return SV.combined(kv, _load_stream(spark, sf_dir), _weather_stream(spark, sf_dir), date=day)


@register("serve_combined_day", f"WITH served AS ({ORACLE_SQL['serve_combined']}) SELECT * FROM served{_DAY_SQL}")
def q_serve_combined_day(spark, sf_dir):
    """V4 + P30: one day, the last one predicted."""
    return _combined_day(spark, sf_dir)


@register("dashboard_day", f"WITH served AS ({ORACLE_SQL['dashboard_rows']}) SELECT * FROM served{_DAY_SQL}")
def q_dashboard_day(spark, sf_dir):
    """V5 + P30 + P31: the table text of that day."""
    return SV.dashboard(_combined_day(spark, sf_dir))


# The time of the batches that fixed answers need.
_BATCH_TIME = "2024-06-01 00:00:00"

# ------------------------------------------------------------------ several runs, compaction


def _two_runs(spark, sf_dir) -> DataFrame:
    """Run a twice, then run b, which predicts one more at every hour."""
    preds = _seasonal_preds(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    FC.append_predictions(preds, path, "a")
    FC.append_predictions(preds, path, "a")
    FC.append_predictions(preds.withColumn("predicted_load_mw", F.round(F.col("predicted_load_mw") + 1, 2)), path, "b")
    return spark.read.parquet(path)


_RUNS_CTE = """
runs AS (
  SELECT ts, predicted_load_mw, 'a' AS run_id FROM preds
  UNION ALL SELECT ts, round(predicted_load_mw + 1, 2), 'b' FROM preds
)"""


@register("append_predictions_rerun", O.with_ctes(*O.FEATURE_CTES, O.PRED_KV_CTE, _RUNS_CTE) + " SELECT * FROM runs")
def q_append_predictions_rerun(spark, sf_dir):
    """K5: a repeated run replaces itself, another one is added."""
    return _two_runs(spark, sf_dir)


@register(
    "export_upsert",
    O.with_ctes(*O.FEATURE_CTES, O.PRED_KV_CTE)
    + " SELECT row_key, round(prediction_value + 1, 2) AS prediction_value, prediction_ts FROM pred_kv"
    " ORDER BY row_key DESC LIMIT 24",
)
def q_export_upsert(spark, sf_dir):
    """K6 over two runs: 24 different hours, each with the latest run's value."""
    return KV.export_latest(_two_runs(spark, sf_dir), n=24)


_COMPACT_CTE = """
log AS (
  SELECT user_id AS key, -event_id AS seq, event_id % 3 AS b,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value, props
  FROM events
),
placed AS (SELECT *, b * 1000000000000 + seq AS o FROM log)"""


@register(
    "kv_compacted_current",
    O.with_ctes(_COMPACT_CTE)
    + """
SELECT key, max_by(seq, o) AS seq,
       max_by(value, o) FILTER (WHERE value IS NOT NULL) AS value,
       max_by(props, o) FILTER (WHERE props IS NOT NULL) AS props
FROM placed GROUP BY key""",
)
def q_kv_compacted_current(spark, sf_dir):
    """K7 across a compaction: three batches, seq running against their order; the last batch wins."""
    ups = AD.keyed_upserts(AD.read_table(spark, sf_dir, "events"))
    log, snapshot = scratch_path(spark, "kv-log"), scratch_path(spark, "kv-snapshot")
    for b in range(3):
        KV.kv_write_batch(ups.where(F.col("seq") % 3 == b).withColumn("seq", -F.col("seq")), log, b)
        if b == 1:
            KV.kv_compact(spark, log, snapshot)
    return KV.kv_current_incremental(spark, snapshot, log).select("key", "seq", "value", "props")


_FOLDED_CTE = f"""
placed AS (
  SELECT event_id % 6 AS b, event_id AS seq,
         CASE WHEN event_id % 50 = 2 THEN 'not a time' ELSE strftime(date_trunc('hour', ts), '{O.KEY_FMT}') END AS key,
         CASE WHEN event_id % 50 = 2 THEN epoch_ms(TIMESTAMP '{_BATCH_TIME}')
              ELSE CAST(epoch_ms(timezone('{O.ZONE}', date_trunc('hour', ts))) AS BIGINT) END AS timestamp_ms,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS current_reading
  FROM events WHERE event_id % 50 NOT IN (0, 1, 3)
)"""


@register(
    "kv_manifest_current",
    O.with_ctes(_FOLDED_CTE)
    + """
SELECT key, max_by(seq, b * 1000000000000 + seq) AS seq, max_by(timestamp_ms, b * 1000000000000 + seq) AS timestamp_ms,
       max_by(current_reading, b * 1000000000000 + seq) FILTER (WHERE current_reading IS NOT NULL) AS current_reading
FROM placed GROUP BY key""",
)
def q_kv_manifest_current(spark, sf_dir):
    """K7 compaction under a manifest: three compactions while six batches arrive; keys without a day among them."""
    at = F.lit(_BATCH_TIME).cast("timestamp_ntz").cast("timestamp")
    messages = AD.odd_load_messages(AD.read_table(spark, sf_dir, "events"))
    parsed = IN.parse_readings(messages, IN.LOAD_SCHEMA, "timestamp", batch_time=F.to_utc_timestamp(at, F.current_timezone()))
    reading = F.when(F.col("seq") % 5 != 0, F.col("current_reading"))
    rows = KV.with_day(parsed.where(~F.col("rejected")).select("key", "seq", "timestamp_ms", reading.alias("current_reading")))
    log = scratch_path(spark, "kv-manifest-log")
    for b in range(6):
        KV.kv_write_batch(rows.where(F.col("seq") % 6 == b), log, b, partition_by=KV.DAY)
        if b in (0, 2, 3):
            CP.compact(spark, log, cells=IN.load_cells(), grace_s=0)  # what was folded is gone afterwards
    return CP.read_current(spark, log, cells=IN.load_cells()).drop(KV.DAY)


@register(
    "kv_null_order",
    O.with_ctes(O.UPSERT_CTE)
    + """,
placed AS (
  SELECT key, seq // 7 AS b, CASE WHEN seq % 7 <> 0 THEN seq END AS seq, value, seq // 7 * 10 + seq % 7 AS o
  FROM upserts
)
SELECT key, max_by(coalesce(seq, -1), o) FILTER (WHERE seq IS NOT NULL OR o % 10 = 0) AS seq_or_none,
       max_by(value, o) FILTER (WHERE value IS NOT NULL) AS value, true AS same_as_struct, true AS same_as_one_column
FROM placed GROUP BY key""",
)
def q_kv_null_order(spark, sf_dir):
    """K7 where the sequence may be null: a null comes first in its batch, in all three forms of the order."""
    ups = AD.keyed_upserts(AD.read_table(spark, sf_dir, "events")).select("key", "seq", "value")
    place = F.expr("seq div 7 * 10 + seq % 7")
    log = ups.withColumns({
        "b": F.expr("seq div 7"), "t": F.lpad(F.expr("seq div 7").cast("string"), 20, "0"),
        "one": F.when(place > 0, place), "seq": F.when(F.col("seq") % 7 != 0, F.col("seq")),
    })
    number = KV.kv_current(log, "key", ("b", "seq"), ["value"])
    struct = KV.kv_current(log, "key", ("t", "seq"), ["value"]).select("key", F.col("seq").alias("_seq"), F.col("value").alias("_value"))
    single = KV.kv_current(log, "key", ("one",), ["value"]).select("key", F.col("value").alias("_single"))
    return number.join(struct, "key").join(single, "key").select(
        "key", F.coalesce("seq", F.lit(-1)).alias("seq_or_none"), "value",
        (F.col("seq").eqNullSafe(F.col("_seq")) & F.col("value").eqNullSafe(F.col("_value"))).alias("same_as_struct"),
        F.col("value").eqNullSafe(F.col("_single")).alias("same_as_one_column"),
    )


# ------------------------------------------------------------------ set-aside rows


@register(
    "csv_quarantine",
    O.with_ctes(O.LOAD_CTE)
    + """
SELECT count(*) FILTER (WHERE h NOT IN (3, 7)) AS good_rows, count(*) FILTER (WHERE h IN (3, 7)) AS bad_rows
FROM (SELECT CAST(substr(datetime_ept, 12, 2) AS INTEGER) % 10 AS h FROM load_data)""",
)
def q_csv_quarantine(spark, sf_dir):
    """S2 + P4, quarantine mode: rows with an empty or unreadable measure are set aside."""
    load, _ = _series(spark, sf_dir)
    last = F.substring(KEY, 13, 1)
    text = F.when(last == "7", "n/a").when(last != "3", F.col("mw").cast("string"))
    path = scratch_path(spark, "quarantine-csv")
    FI.write_series_csv(load.select(KEY, text.alias("mw")), path, order=None)
    good, bad = FI.read_series_csv(spark, path, LOAD, on_error="quarantine")
    both = good.select(F.lit(True).alias("ok")).unionByName(bad.select(F.lit(False).alias("ok")))
    return both.agg(F.count_if("ok").alias("good_rows"), F.count_if(~F.col("ok")).alias("bad_rows"))


@register(
    "csv_own_headers",
    O.with_ctes(O.LOAD_CTE)
    + """
SELECT datetime_ept, mw FROM load_data WHERE CAST(substr(datetime_ept, 12, 2) AS INTEGER) % 3 < 2
UNION ALL SELECT 'files without mw', 1.0""",
)
def q_csv_own_headers(spark, sf_dir):
    """S2 + S3 with other headers: swapped and extra columns are found by name, a file without a column is set aside."""
    load, _ = _series(spark, sf_dir)
    root = scratch_path(spark, "own-headers")
    hour = F.substring(KEY, 12, 2).cast("int") % 3
    shapes = [load, load.select(F.lit("x").alias("note"), "mw", KEY), load.select(KEY, F.col("mw").alias("load"))]
    for i, shape in enumerate(shapes):
        FI.write_series_csv(shape.where(hour == i).coalesce(1), f"{root}/shape{i}", order=None)
    rows, aside = FI.read_by_own_headers(spark, f"{root}/*", [f.name for f in LOAD.fields])
    typed = FI.typed_series(rows, LOAD, on_error="raise")
    listed = aside.where(F.array_contains("missing", "mw")).agg(F.count(F.lit(1)).cast("double").alias("mw"))
    return typed.unionByName(listed.select(F.lit("files without mw").alias(KEY), "mw"))


# ------------------------------------------------------------------ model results that SQL can state


_TEST_ROWS = f"numbered WHERE _rn >= (SELECT c FROM cut) AND {_NOT_NULL_19}"


@register(
    "model_metrics_check",
    _SPLIT_SQL
    + f" SELECT count(*) AS n_test_scored, 19 AS n_features, 4 AS grid_points, 3 AS folds, true AS better_than_mean FROM {_TEST_ROWS}",
)
def q_model_metrics_check(spark, sf_dir):
    """M2-M6 + A3: sizes of the full grid search, and a hold-out RMSE below that of the training mean."""
    model, train, test = _trained(spark, sf_dir)
    mean = train.agg(F.avg("mw")).first()[0]  # one scalar

    def error(pred):
        return F.sqrt(F.avg((pred - F.col("mw")) * (pred - F.col("mw"))))

    return ML.score(model, test).agg(
        F.count(F.lit(1)).alias("n_test_scored"),
        F.lit(len(ML.feature_columns(train.drop("mw")))).alias("n_features"),
        F.lit(len(model.getEstimatorParamMaps())).alias("grid_points"),
        F.lit(model.getNumFolds()).alias("folds"),
        (error(F.col("prediction")) < error(F.lit(mean))).alias("better_than_mean"),
    )


@register("feature_importance_check", "SELECT CAST(19 AS BIGINT) AS n_features, true AS none_negative, CAST(1 AS DOUBLE) AS total")
def q_feature_importance_check(spark, sf_dir):
    """O5: all 19 importances, none negative, together 1 (to 9 decimals)."""
    model, _, _ = _trained(spark, sf_dir)
    return ML.feature_importance(model, -1.0).agg(
        F.count_distinct("feature").alias("n_features"),
        (F.min("importance") >= 0).alias("none_negative"),
        F.round(F.sum("importance"), 9).alias("total"),
    )


@register(
    "model_forward_check",
    _SPLIT_SQL + f" SELECT count(*) AS n_test_scored, 4 AS grid_points, true AS better_than_mean, true AS folds_scored FROM {_TEST_ROWS}",
)
def q_model_forward_check(spark, sf_dir):
    """M5 + D22: the grid searched by forward chaining; the model beats the training mean on the hold-out."""
    train, test = SE.select_split(_stored_frame(spark, sf_dir))
    model = ML.train_forward(train)
    mean = train.agg(F.avg("mw")).first()[0]  # one scalar

    def error(pred):
        return F.sqrt(F.avg((pred - F.col("mw")) * (pred - F.col("mw"))))

    return ML.score(model, test).agg(
        F.count(F.lit(1)).alias("n_test_scored"),
        F.lit(len(model.avgMetrics)).alias("grid_points"),
        (error(F.col("prediction")) < error(F.lit(mean))).alias("better_than_mean"),
        F.lit(all(0 < m < float("inf") for m in model.avgMetrics)).alias("folds_scored"),
    )


@register("model_reload_check", _SPLIT_SQL + f" SELECT count(*) AS n_rows, count(*) AS n_equal FROM {_TEST_ROWS}")
def q_model_reload_check(spark, sf_dir):
    """K8 + S8 + M6 + M8: the model that was saved and loaded scores every test row alike."""
    model, _, test = _trained(spark, sf_dir)
    path = scratch_path(spark, "model")
    ML.save_model(model, path)
    before = ML.score(model, test).select("ts", "prediction")
    after = ML.score(ML.load_model(path), test).select("ts", F.col("prediction").alias("_after"))
    return before.join(after, "ts", "full").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("_after")).alias("n_equal")
    )


@register(
    "forecast_24h_check",
    O.with_ctes(O.LOAD_CTE, O.WEATHER_CTE, O.JOINED_CTE, O.FORECAST_CTE) + " SELECT ts, true AS in_training_range FROM fc WHERE _future",
)
def q_forecast_24h_check(spark, sf_dir):
    """M6 + M7: 24 hours, each within the range of the training loads (a forest can't leave it)."""
    model, train, _ = _trained(spark, sf_dir)
    low, high = train.agg(F.round(F.min("mw"), 2), F.round(F.max("mw"), 2)).first()  # two scalars
    preds = FC.forecast(model, FC.forecast_inputs(_joined(spark, sf_dir), avg_scale=CENTS))
    return preds.select("ts", F.col("predicted_load_mw").between(low, high).alias("in_training_range"))


# ------------------------------------------------------------------ a stream of several batches with bad messages


_STREAM_FILES = 8
#: Messages that are worth a file, and so a task of their own, within a batch.
_FILE_MESSAGES = 1 << 17


def _write_stream_files(messages: DataFrame, path: str) -> int:
    """Write messages in eight parts by ``seq``, each as equally many files; -> files a part.

    A file's messages are parsed by one task, so long parts take several files.
    """
    files = max(1, -(-messages.count() // (_STREAM_FILES * _FILE_MESSAGES)))
    if files == 1:
        messages.repartitionByRange(_STREAM_FILES, "seq").write.parquet(path)
    else:
        # the salt parts messages of one seq, so that no file is left out as empty
        salted = messages.withColumn("_salt", F.monotonically_increasing_id())
        salted.repartitionByRange(_STREAM_FILES * files, "seq", "_salt").drop("_salt").write.parquet(path)
    return files


def _odd_stream(spark, sf_dir, runs: int = 1, **options) -> dict[str, str]:
    """Odd messages in eight batches of one file each (of more, if they are many); with two runs the
    whole stream is replayed (a new checkpoint) into the same folders.  -> paths of log, rejects and metrics."""
    messages = AD.odd_load_messages(AD.read_table(spark, sf_dir, "events"))
    source = scratch_path(spark, "stream-in")
    files = _write_stream_files(messages, source)
    paths = {name: scratch_path(spark, f"stream-{name}") for name in ("log", "rejects", "metrics")}
    for _ in range(runs):
        src = IN.file_message_stream(spark, source, messages.schema, max_files=files)
        at = F.lit(_BATCH_TIME).cast("timestamp_ntz").cast("timestamp")
        parsed = IN.parse_readings(src, IN.LOAD_SCHEMA, "timestamp", batch_time=F.to_utc_timestamp(at, F.current_timezone()))
        IN.run_for(IN.start_ingest(
            parsed, paths["log"], scratch_path(spark, "stream-ckpt"), IN.load_cells(), trigger={"availableNow": True},
            reject_path=paths["rejects"], metrics_path=paths["metrics"], **options,
        ))
    return paths


@register("stream_rejects", "SELECT event_id AS seq, value AS current_reading FROM events WHERE event_id % 50 = 1")
def q_stream_rejects(spark, sf_dir):
    """P24 + T7: messages with an empty key are set aside, null keys and broken JSON dropped; the stream goes on."""
    return spark.read.parquet(_odd_stream(spark, sf_dir)["rejects"]).select("seq", "current_reading")


@register(
    "stream_metrics",
    f"""
SELECT CAST({_STREAM_FILES} AS BIGINT) AS batches, CAST(count(*) FILTER (WHERE event_id % 50 NOT IN (0, 3)) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE event_id % 50 = 1) AS BIGINT) AS rejected,
       CAST(count(*) FILTER (WHERE event_id % 50 NOT IN (0, 1, 3)) AS BIGINT) AS written
FROM events""",
)
def q_stream_metrics(spark, sf_dir):
    """A4 + T1: the counts of each batch, one file a batch, summed up."""
    kept = spark.read.parquet(_odd_stream(spark, sf_dir)["metrics"])
    return kept.agg(
        F.count_distinct(KV.BATCH).alias("batches"), F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), F.sum("written").alias("written")
    )


@register(
    "stream_replay",
    f"""
SELECT event_id AS seq, CASE WHEN event_id % 50 = 2 THEN 'not a time' ELSE strftime(date_trunc('hour', ts), '{O.KEY_FMT}') END AS key,
       CASE WHEN event_id % 50 = 2 THEN epoch_ms(TIMESTAMP '{_BATCH_TIME}')
            ELSE CAST(epoch_ms(timezone('{O.ZONE}', date_trunc('hour', ts))) AS BIGINT) END AS timestamp_ms,
       value AS current_reading
FROM events WHERE event_id % 50 NOT IN (0, 1, 3)""",
)
def q_stream_replay(spark, sf_dir):
    """T4 + T8 + P25: the stream run twice leaves every message once; an unreadable key gets the batch's time."""
    return KV.kv_read_log(spark, _odd_stream(spark, sf_dir, runs=2)["log"]).select("seq", "key", "timestamp_ms", "current_reading")


@register(
    "stream_progress",
    f"SELECT CAST({_STREAM_FILES} AS BIGINT) AS batches, count(*) AS input_rows, true AS all_written FROM events",
)
def q_stream_progress(spark, sf_dir):
    """T9 + A4: each batch's progress as a row, as Spark reports it; the same batches as the writer's own counts."""
    name = f"progress-{uuid.uuid4().hex[:8]}"
    listener = CO.ProgressRows(name)
    spark.streams.addListener(listener)
    try:
        paths = _odd_stream(spark, sf_dir, gate=CO.BatchGate(), name=name)
        rows = listener.frame(spark)
    finally:
        spark.streams.removeListener(listener)
    counted = spark.read.parquet(paths["metrics"]).select(F.col(KV.BATCH).cast("long").alias("batch_id"), "rows")
    # the writer drops broken messages before it counts
    both = rows.where("input_rows > 0").join(counted, "batch_id", "full")
    return both.agg(
        F.count("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"), F.coalesce(F.bool_and(F.col("rows") <= F.col("input_rows")), F.lit(True)).alias("all_written")
    )


# ------------------------------------------------------------------ expiring state, live join


_ROUNDS = 2


@register(
    "stream_load_expiring",
    O.with_ctes(O.LOAD_MSG_CTE)
    + f""",
arrived AS (
  SELECT *, seq % {_ROUNDS} AS round FROM load_msg UNION ALL SELECT *, {_ROUNDS} FROM load_msg WHERE seq % {_ROUNDS} = 0
),
ordered AS (SELECT *, round * 1000000000000 + seq AS o FROM arrived)
SELECT key, max_by(seq, o) AS seq, max_by(CAST(epoch_ms(timezone('{O.ZONE}', CAST(key AS TIMESTAMP))) AS BIGINT), o) AS timestamp_ms,
       max_by(current_reading, o) FILTER (WHERE current_reading IS NOT NULL) AS current_reading
FROM ordered GROUP BY key""",
)
def q_stream_load_expiring(spark, sf_dir):
    """K7 + T8 with state that expires: late messages every round, the first round's replayed at the end, a restart between rounds."""
    messages = IN.load_messages(AD.read_table(spark, sf_dir, "events"))
    source, out, ckpt = (scratch_path(spark, f"expiring-{x}") for x in ("in", "out", "ckpt"))
    for i in range(_ROUNDS + 1):
        messages.where(F.col("seq") % _ROUNDS == i % _ROUNDS).write.parquet(f"{source}/round={i}")
        src = IN.file_message_stream(spark, f"{source}/round=*", messages.schema)
        parsed = IN.parse_readings(src.select("value", "seq"), IN.LOAD_SCHEMA, "timestamp")
        # what a round leaves may or may not have expired by the next one: the rows are the same
        IN.run_for(EX.start_expiring_view(parsed, out, ckpt, IN.load_cells(), ttl_s=10, trigger={"availableNow": True}), timeout_s=600)
    return EX.read_expiring_view(spark, out, IN.load_cells()).drop(KV.DAY)


_LIVE_PARTS = 4
_CLOSING = "9999-01-01 00:00:00"


def _live_source(spark, messages, key, label):
    """Messages in parts of time, each its own files, then one far ahead that lets the watermark pass all hours."""
    path = scratch_path(spark, label)
    at = F.get_json_object("value", f"$.{key}")
    part = F.least(F.expr(f"cast(substring(get_json_object(value, '$.{key}'), 9, 2) as int) div 9"), F.lit(_LIVE_PARTS - 1))
    for i in range(_LIVE_PARTS):
        messages.where(part == i).where(at < _CLOSING).write.parquet(f"{path}/part={i}")
    closing = spark.createDataFrame([(f'{{"{key}": "{_CLOSING}"}}', -1)], messages.schema)
    closing.write.parquet(f"{path}/part={_LIVE_PARTS}")
    return IN.file_message_stream(spark, f"{path}/part=*", messages.schema, max_files=1 << 20).select("value", "seq")


@register(
    "live_combined",
    O.with_ctes(O.LOAD_MSG_CTE, O.WEATHER_MSG_CTE)
    + """,
errors AS (SELECT w.* FROM weather_msg w JOIN events e ON e.event_id = w.seq WHERE e.event_type = 'error'),
by_hour AS (SELECT key, max_by(temp, seq) FILTER (WHERE temp IS NOT NULL) AS temp, max_by(hmdt, seq) FILTER (WHERE hmdt IS NOT NULL) AS hmdt FROM errors GROUP BY key)
SELECT l.key, l.current_reading, h.temp, h.hmdt FROM load_kv l LEFT JOIN by_hour h USING (key)""",
)
def q_live_combined(spark, sf_dir):
    """J2 + V4 live: two streams joined by hour under watermarks, hours without weather included; equals the batch join."""
    ev = AD.read_table(spark, sf_dir, "events")
    load = IN.parse_readings(_live_source(spark, IN.load_messages(ev), "timestamp", "live-load"), IN.LOAD_SCHEMA, "timestamp")
    weather = IN.parse_readings(_live_source(spark, IN.weather_messages(ev.where("event_type = 'error'")), KEY, "live-weather"), IN.WEATHER_SCHEMA, KEY)
    out = scratch_path(spark, "live-out")
    joined = LI.live_combined(load, weather, ["current_reading"], ["temp", "hmdt"])
    IN.run_for(LI.start_live(joined, out, scratch_path(spark, "live-ckpt"), trigger={"availableNow": True}), timeout_s=600)
    return spark.read.parquet(out).select("key", "current_reading", "temp", "hmdt")
