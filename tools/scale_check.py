"""Halo-blocked vs single-partition windows as one series grows.

python tools/scale_check.py [sf_dir] [factors...]

The driver's ``events`` table is replicated k times into ONE longer series
(time shifted by 31 days per copy, ids offset), then ``lag_profile`` (lags 1,
24, 168 and the 168-row average) runs both ways into the ``noop`` sink.
Also times the many-series form (per user) on the same rows.  Prints one
JSON line per factor.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    factors = [int(a) for a in argv[1:]] or [1, 32, 128]
    from pyspark.sql import functions as F

    from loadcast.operators.features import lag_profile
    from loadcast.session import build_session, ensure_checkpoint_root, scratch_scope
    from loadcast.sources.adapters import event_series, read_table

    spark = build_session("loadcast-scale", master="local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_root(spark)
    ev = event_series(read_table(spark, sf_dir, "events"))

    def timed(df) -> float:
        t = time.perf_counter()
        with scratch_scope(spark):
            df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t, 2)

    timed(lag_profile(ev))  # warm-up
    for k in factors:
        rep = ev.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).select(
            (F.col("event_id") + F.col("_c") * F.lit(1 << 40)).alias("event_id"),
            (F.col("ts") + F.make_interval(days=F.col("_c") * 31)).alias("ts"),
            "user_id",
            "mw",
        )
        rows = ev.count() * k
        out = {"rows": rows, "factor": k}
        out["halo_one_series_s"] = timed(lag_profile(rep))
        out["global_one_series_s"] = timed(lag_profile(rep, method="global"))
        out["halo_per_user_s"] = timed(lag_profile(rep, series_keys=("user_id",)))
        print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
