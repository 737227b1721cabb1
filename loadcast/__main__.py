"""Command line: ``python -m loadcast <command> ...`` locally, or on a cluster
``spark-submit --py-files loadcast.zip loadcast/__main__.py <command> ...``.

Commands mirror the batch, speed and serving layers:

  clean-weather   RAW_CSV OUT_CSV [--quarantine]
  csv-to-parquet  LOAD_CSV WEATHER_CSV LOAD_PARQUET WEATHER_PARQUET
  features        LOAD_PARQUET WEATHER_PARQUET TABLE PATH
  train           FEATURES_PARQUET MODEL_PATH [--grid reference|quick] [--folds 3] [--forward]
  predict         MODEL_PATH LOAD_PARQUET WEATHER_PARQUET PREDICTIONS [--run-id ID] [--start TS] [--hours 24]
  export          PREDICTIONS OUT [--n 24] [--batch-id N]   (an upsert: one batch per export)
  ingest          load|weather SOURCE LOG CHECKPOINT [--kafka SERVERS] [--topic T] [--available-now]
                  [--timeout S] [--reject-path P] [--metrics-path P] [--stateful]
                  [--max-per-trigger N] [--starting-offsets latest|earliest|JSON] [--trigger-seconds 10]
  compact         load|weather|predictions LOG [--grace SECONDS]
  combined        DATE PREDICTIONS_KV LOAD_LOG WEATHER_LOG [--dashboard] [--views]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession


def _session() -> SparkSession:
    from loadcast.session import build_session

    return build_session("loadcast-cli")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from loadcast.ml import model as ML
    from loadcast.operators import compaction as CP
    from loadcast.operators import kv as KV
    from loadcast.plans import jobs as J
    from loadcast.plans import serving as SV
    from loadcast.schemas import LOAD, WEATHER
    from loadcast.streaming import ingest as IN
    from loadcast.streaming.control import BatchGate

    p = argparse.ArgumentParser(prog="loadcast", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("clean-weather")
    c.add_argument("raw_csv")
    c.add_argument("out_csv")
    c.add_argument("--quarantine", action="store_true")

    c = sub.add_parser("csv-to-parquet")
    for a in ("load_csv", "weather_csv", "load_parquet", "weather_parquet"):
        c.add_argument(a)

    c = sub.add_parser("features")
    for a in ("load_parquet", "weather_parquet", "table", "path"):
        c.add_argument(a)

    c = sub.add_parser("train")
    c.add_argument("features_parquet")
    c.add_argument("model_path")
    c.add_argument("--grid", choices=["reference", "quick"], default="reference")
    c.add_argument("--folds", type=int, default=ML.REFERENCE_FOLDS)
    c.add_argument("--forward", action="store_true", help="folds that learn from the past only")

    c = sub.add_parser("predict")
    for a in ("model_path", "load_parquet", "weather_parquet", "predictions"):
        c.add_argument(a)
    c.add_argument("--run-id")
    c.add_argument("--start")
    c.add_argument("--hours", type=int, default=24)

    c = sub.add_parser("export")
    c.add_argument("predictions")
    c.add_argument("out", help="keyed predictions log: each export is one batch (an upsert)")
    c.add_argument("--n", type=int, default=24)
    c.add_argument("--batch-id", type=int, help="defaults to the current epoch second")

    c = sub.add_parser("ingest")
    c.add_argument("kind", choices=["load", "weather"])
    c.add_argument("source", help="Parquet message folder (value, seq) unless --kafka")
    c.add_argument("log")
    c.add_argument("checkpoint")
    c.add_argument("--kafka", help="bootstrap servers; SOURCE is then ignored")
    c.add_argument("--topic")
    c.add_argument("--available-now", action="store_true")
    c.add_argument("--timeout", type=float)
    c.add_argument("--reject-path")
    c.add_argument("--metrics-path")
    c.add_argument("--stateful", action="store_true", help="keep the current row per key in streaming state")
    c.add_argument("--max-per-trigger", type=int, default=100, help="files, or Kafka records, of one batch; 0: no limit")
    c.add_argument("--starting-offsets", default="latest", help="Kafka: where a first start begins (latest, earliest or JSON)")
    c.add_argument("--trigger-seconds", type=float, default=10)

    c = sub.add_parser("compact")
    c.add_argument("kind", choices=sorted(J.LOGS))
    c.add_argument("log")
    c.add_argument("--grace", type=float, default=86_400, help="seconds that folders out of use are kept")

    c = sub.add_parser("combined")
    for a in ("date", "predictions_kv", "load_log", "weather_log"):
        c.add_argument(a)
    c.add_argument("--dashboard", action="store_true")
    c.add_argument("--views", action="store_true", help="LOAD_LOG / WEATHER_LOG are stateful current views")

    args = p.parse_args(argv)
    spark = spark or _session()

    if args.cmd == "clean-weather":
        n = J.clean_weather_file(spark, args.raw_csv, args.out_csv, "quarantine" if args.quarantine else "raise")
        print(f"clean weather rows: {n}")
    elif args.cmd == "csv-to-parquet":
        n_load, n_weather = J.csv_to_parquet(spark, args.load_csv, args.weather_csv, args.load_parquet, args.weather_parquet)
        print(f"load rows: {n_load}, weather rows: {n_weather}")
    elif args.cmd == "features":
        df = J.build_training_table(_read(spark, args.load_parquet, LOAD), _read(spark, args.weather_parquet, WEATHER), args.table, args.path)
        print(f"feature rows: {df.count()}")
    elif args.cmd == "train":
        grid = None if args.grid == "reference" else {"numTrees": [20], "maxDepth": [8]}
        res = J.run_model_training(spark.read.parquet(args.features_parquet), args.model_path, grid=grid, folds=args.folds, forward=args.forward)
        res.bounds.show(truncate=False)
        print(f"features: {res.n_features}  test RMSE: {res.rmse:.4f} MW")
        res.importances.show(truncate=False)
    elif args.cmd == "predict":
        out = J.run_prediction(
            spark, args.model_path, _read(spark, args.load_parquet, LOAD), _read(spark, args.weather_parquet, WEATHER),
            args.predictions, run_id=args.run_id, start=args.start, hours=args.hours,
        )
        if out is None:
            print(f"no model at {args.model_path}", file=sys.stderr)
            return 2
        print(f"prediction rows now stored: {out.count()}")
    elif args.cmd == "export":
        import time

        batch_id = args.batch_id if args.batch_id is not None else int(time.time())
        latest = KV.with_day(J.export_predictions(spark.read.parquet(args.predictions), n=args.n), key="row_key")
        KV.kv_write_batch(latest, args.out, batch_id, partition_by="dt")
        print(f"exported batch {batch_id} to {args.out}")
    elif args.cmd == "ingest":
        schema, key, cells = (
            (IN.LOAD_SCHEMA, "timestamp", IN.load_cells())
            if args.kind == "load"
            else (IN.WEATHER_SCHEMA, "datetime_ept", IN.weather_cells())
        )
        limit = args.max_per_trigger or None
        if args.kafka:
            src = IN.kafka_message_stream(spark, args.kafka, args.topic, limit, args.starting_offsets)
        else:
            src = IN.file_message_stream(spark, args.source, "value string, seq long", limit)
        trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.trigger_seconds:g} seconds"}
        parsed = IN.parse_readings(src, schema, key)
        if args.stateful:
            q = IN.start_current_view(parsed, args.log, args.checkpoint, cells, trigger)
        else:
            gate = BatchGate()
            q = IN.start_ingest(
                parsed, args.log, args.checkpoint, cells, trigger,
                reject_path=args.reject_path, metrics_path=args.metrics_path, gate=gate,
            )
        IN.run_for(q, args.timeout, continuous=not args.available_now, gate=None if args.stateful else gate)
    elif args.cmd == "compact":
        made = J.compact_log(spark, args.kind, args.log, args.grace)
        print(f"manifest version {made.version}: {len(made.days)} days, through batch {made.through}")
    elif args.cmd == "combined":
        if args.views:
            load_kv = IN.read_current_view(spark, args.load_log, IN.load_cells())
            weather_kv = IN.read_current_view(spark, args.weather_log, IN.weather_cells())
        else:
            load_kv = J.current_table(spark, "load", args.load_log)
            weather_kv = J.current_table(spark, "weather", args.weather_log)
        # an export log (the latest value per key wins), or a plain keyed table
        is_log = CP.is_log(spark, args.predictions_kv)
        preds = J.current_table(spark, "predictions", args.predictions_kv) if is_log else KV.kv_read_log(spark, args.predictions_kv)
        comb = SV.combined(preds, load_kv, weather_kv, date=args.date)
        (SV.dashboard(comb) if args.dashboard else comb).orderBy("datetime").show(48, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
