"""Window features of appended rows, from a short state instead of the whole history.

Every window reaches back a bounded number of rows, so the features of new rows
need, of each series, only its last ``reach`` rows.  These are the state: after each
slice they are written whole as ``<state>/slice=N``; the next slice windows them and
its own rows together, keeps the features of its own, and writes the next state.
Slices written again (a rerun) start from the same state and replace themselves.

A state keeps each row's place from its series' end, so a slice numbers only its own
rows; the state goes through the windows' exchange and one join with a row a series.

Ten slices give the rows of one full run, as long as a series' rows arrive in
order: a slice with a row before its series' state raises, as its neighbours' features
would be wrong.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.operators.features import default_tie_break, time_features, weather_features, window_feature_exprs
from loadcast.operators.sequence import halo_windows, sized_sequence
from loadcast.session import drop_path, target_partitions

_NEW = "_new"
#: In a state: the row's place from the end of its series (1: the last row).
_BACK = "_back"


def _state_slices(spark, state_path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(state_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    whole = [p.getName() for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(m[1]) for m in (re.fullmatch(r"slice=(\d+)", n) for n in whole) if m)


def _same_series(series_keys: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in series_keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def _assert_later(tail: DataFrame, rows: DataFrame, order: str, series_keys: Sequence[str]) -> bool:
    """No new row stands before the last known one of its series; -> whether one stands beside it."""
    if _BACK in tail.columns:
        last = tail.where(F.col(_BACK) == 1).select(*series_keys, F.col(order).alias("_last"))
    else:
        last = tail.groupBy(*series_keys).agg(F.max(order).alias("_last"))
    first = rows.groupBy(*series_keys).agg(F.min(order).alias("_first"), F.count_if(F.col(order).isNull()).alias("_nulls"))
    first = first.withColumnsRenamed({k: f"_f_{k}" for k in series_keys})
    is_late = (F.col("_first") < F.col("_last")) | (F.col("_nulls") > 0)
    seen = last.join(first, _same_series(series_keys, "_f_")).agg(
        F.first(F.when(is_late, F.struct("*")), ignorenulls=True).alias("late"), F.count_if(F.col("_first") == F.col("_last")).alias("beside")
    ).first()
    if seen["late"]:
        raise ValueError(f"rows before the last known one of their series: {seen['late'].asDict()}")
    return seen["beside"] > 0


def window_slice(
    rows: DataFrame, tail: DataFrame | None, order: str = "ts", series_keys: Sequence[str] = (), avg_scale: int | None = None, include_current: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(features of ``rows``, the next tail): lags, changes and averages over ``tail`` and ``rows`` together."""
    exprs, reach = window_feature_exprs(include_current, avg_scale)
    ties = default_tie_break(rows, [order, *series_keys])
    new = rows.withColumn(_NEW, F.lit(True))
    back = (F.col("_size") - F.col("_rn")).alias(_BACK)
    beside = tail is not None and _assert_later(tail, rows, order, series_keys)
    if tail is not None and (beside or _BACK not in tail.columns):
        # rows of the tail come first where times are equal; among themselves they go by all columns
        both = tail.select(*rows.columns).withColumn(_NEW, F.lit(False)).unionByName(new)
        seq, n = sized_sequence(both, [order, _NEW, *ties], series_keys=series_keys, rn_col="_rn", size_col="_size")
    else:
        seq, n = sized_sequence(new, [order, *ties], series_keys=series_keys, rn_col="_rn", size_col="_size")
    kept = seq.select(*rows.columns, back).where(F.col(_BACK) <= reach)
    seq = seq.drop("_size")
    if tail is not None and not beside and _BACK in tail.columns:
        # the tail's rows get the numbers below 0: they are in the first block, before its rows
        old = tail.select(*rows.columns, F.lit(False).alias(_NEW), (-F.col(_BACK)).alias("_rn"))
        sizes = rows.groupBy(*[F.col(k).alias(f"_s_{k}") for k in series_keys]).agg(F.count(F.lit(1)).alias("_more"))
        sizes = sizes.hint("shuffle_hash") if series_keys else F.broadcast(sizes)
        moved = tail.join(sizes, _same_series(series_keys, "_s_"), "left")
        moved = moved.select(*rows.columns, (F.col(_BACK) + F.coalesce("_more", F.lit(0))).alias(_BACK))
        kept = kept.unionByName(moved.where(F.col(_BACK) <= reach))
        seq = seq.unionByName(old)
        n = sum(filter(None, (n, target_partitions(tail)))) or None
    out = halo_windows(seq, exprs, reach=reach, series_keys=series_keys, rn_col="_rn", num_partitions=n)
    return out.where(F.col(_NEW)).drop(_NEW, "_rn"), kept


def append_features(
    rows: DataFrame, out_path: str, state_path: str, slice_id: int, order: str = "ts", series_keys: Sequence[str] = (), avg_scale: int | None = None
) -> None:
    """Write the features of a slice of joined rows as ``<out>/slice=N`` and the state after it.

    Reads the latest state before the slice, no older rows.  The two latest states are kept.
    """
    spark = rows.sparkSession
    before = [s for s in _state_slices(spark, state_path) if s < slice_id]
    tail = None
    if before:
        path = f"{state_path}/slice={before[-1]}"
        placed = _BACK in spark.read.parquet(path).columns  # older states have no places
        schema = T.StructType([*rows.schema.fields, *([T.StructField(_BACK, T.LongType())] if placed else [])])
        tail = spark.read.schema(schema).parquet(path)
    feats, kept = window_slice(rows, tail, order, series_keys, avg_scale)
    weather_features(time_features(feats)).write.mode("overwrite").parquet(f"{out_path}/slice={slice_id}")
    kept.write.mode("overwrite").parquet(f"{state_path}/slice={slice_id}")
    for old in before[:-1]:
        drop_path(spark, f"{state_path}/slice={old}")
