"""Keyed upsert tables as an append-only Parquet log plus a merge view.

The reference writes one Put per row into a key-value store, and a null
measure writes no cell, so an older value of that cell survives.  Here:

* each micro-batch is written by the executors as ``<log>/batch_id=N`` with
  overwrite, so a replayed batch replaces itself (idempotent);
* the current table is an aggregation per key: for every cell, the value of
  the latest row (by batch, then sequence) where that cell is not null.
  ``max_by`` is a declarative aggregate with map-side partial aggregation, so
  a hot key is combined before the shuffle;
* ``kv_compact`` folds the log into a snapshot that later merges treat as
  one older row per key; ``kv_current_incremental`` merges the snapshot with
  only the newer batch folders;
* a log or table may be partitioned by the key's day (``with_day``), below the
  batch: the merge keeps the day as a second grouping column, so a day range
  on the current table reaches the scan and prunes folders;
* ``operators/compaction.py`` keeps a growing log short under a manifest.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.timekeys import DEFAULT_ZONE, epoch_seconds, format_key

BATCH = "batch_id"
#: Partition column of logs and tables that are partitioned by the key's day.
DAY = "dt"
#: Where the keys without a readable day are kept.
OTHER_DAY = "other"


# More than all values of a long, and less than all of them.
_STEP = Decimal(2 * 10**19)
_BELOW = Decimal(-(2**63) - 1)


def _order(order_cols: Sequence[str], kinds: dict[str, T.DataType]) -> tuple[Column, Column]:
    """(what "latest" goes by, the latest value of the last order column); a null sorts before all values.

    One or two integer columns become one number (a struct would make the merge
    sort its rows); others a struct, which isn't null when its fields are.
    """
    cols = [F.col(c) for c in order_cols]
    if len(cols) > 2 or not all(isinstance(kinds[c], T.IntegralType) for c in order_cols):
        ordv = F.struct(*cols)
        return ordv, F.max(ordv)[order_cols[-1]]
    ordv = F.coalesce(cols[-1].cast("decimal(19,0)"), F.lit(_BELOW).cast("decimal(19,0)")).cast("decimal(38,0)")
    if len(cols) == 2:
        # batch numbers of up to 18 digits
        first = F.coalesce(cols[0].cast("decimal(18,0)").cast("decimal(19,0)"), F.lit(Decimal(-(10**18))).cast("decimal(19,0)"))
        ordv = (first * F.lit(_STEP)).cast("decimal(38,0)") + ordv.cast("decimal(19,0)")
    # the last number again: what is left beside the multiples of the step
    place = F.pmod(F.max(ordv) + F.lit(_STEP / 2), F.lit(_STEP)) - F.lit(_STEP / 2)
    return ordv, F.when(place > F.lit(_BELOW), place).cast(kinds[order_cols[-1]])


def kv_current(
    log: DataFrame,
    key: str = "key",
    order_cols: Sequence[str] = ("seq",),
    cells: Sequence[str] | None = None,
    day: str | None = None,
) -> DataFrame:
    """Per key, each cell's latest non-null value; ``order_cols`` define "latest" (a null is the earliest).

    A cell that was never non-null stays null.  The latest order value per key
    is kept under the last order column's name (e.g. ``seq``).  ``day`` names a
    column that depends on the key alone; it's kept, and filters on it and on
    the key are applied before the merge.
    """
    if cells is None:
        cells = [c for c in log.columns if c not in (key, *order_cols, BATCH, day)]
    ordv, last = _order(order_cols, {f.name: f.dataType for f in log.schema.fields})
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordv)).alias(c) for c in cells]
    return log.groupBy(key, *([day] if day else [])).agg(last.alias(order_cols[-1]), *aggs)


def kv_cells(
    df: DataFrame, key: str = "key", seq: str = "seq", cells: Sequence[str] | None = None
) -> DataFrame:
    """Wide rows -> (key, seq, column, value) cells as text, null cells omitted."""
    if cells is None:
        cells = [c for c in df.columns if c not in (key, seq)]
    as_text = df.select(key, seq, *[F.col(c).cast("string").alias(c) for c in cells])
    long = as_text.unpivot([key, seq], list(cells), "column", "value")
    return long.where(F.col("value").isNotNull())


def kv_from_cells(
    cells_df: DataFrame,
    columns: dict[str, str],
    key: str = "key",
    seq: str = "seq",
) -> DataFrame:
    """Text cells (key, seq, column, value) -> one typed row per key.

    Each column takes its latest cell; ``columns`` maps a cell name to its
    type, and text that does not parse becomes null (``try_cast``).  The
    pivot values are given, so Spark runs no extra job to find them.
    """
    order, _ = _order((seq,), {f.name: f.dataType for f in cells_df.schema.fields})
    latest = cells_df.groupBy(key, "column").agg(F.max_by("value", order).alias("value"), F.max(seq).alias("_s"))
    wide = latest.groupBy(key).pivot("column", list(columns)).agg(F.first("value"))
    seqs = latest.groupBy(key).agg(F.max("_s").alias(seq))
    return wide.join(seqs, key).select(
        key, seq, *[F.col(c).try_cast(t).alias(c) for c, t in columns.items()]
    )


def kv_write_batch(batch: DataFrame, log_path: str, batch_id: int, partition_by: str | None = None) -> None:
    """Write one batch into the log; a replay of the same id overwrites it.

    ``partition_by`` (e.g. the key's day) nests a second partition level below
    the batch folder, so range scans prune across all batches.
    """
    w = batch.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(f"{log_path.rstrip('/')}/{BATCH}={int(batch_id)}")


def kv_read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All batches there are; the day, if the log has it, as text (Spark may take the folder names for dates)."""
    log = spark.read.parquet(log_path)
    return log.withColumn(DAY, F.col(DAY).cast("string")) if DAY in log.columns else log


def kv_compact(
    spark: SparkSession,
    log_path: str,
    snapshot_path: str,
    key: str = "key",
    order_cols: Sequence[str] = (BATCH, "seq"),
    cells: Sequence[str] | None = None,
) -> DataFrame:
    """Fold the whole log into a snapshot (one row per key) and return it."""
    log = kv_read_log(spark, log_path)
    current = kv_current(log, key, order_cols, cells)
    last_batch = log.groupBy(key).agg(F.max(BATCH).alias(BATCH))
    current.drop(BATCH).join(last_batch, key).write.mode("overwrite").parquet(snapshot_path)
    return spark.read.parquet(snapshot_path)


def kv_current_incremental(
    spark: SparkSession,
    snapshot_path: str,
    log_path: str,
    key: str = "key",
    order_cols: Sequence[str] = (BATCH, "seq"),
    cells: Sequence[str] | None = None,
) -> DataFrame:
    """Current table = snapshot merged with only the log batches written after it.

    The log is partitioned by ``batch_id``, so the filter prunes every folder
    the snapshot already covers.  A snapshot row stands for one row per key
    ordered before all newer batches: a newer non-null cell wins, a newer
    null leaves the snapshot's cell.
    """
    snap = spark.read.parquet(snapshot_path)
    last = snap.agg(F.max(BATCH)).first()[0]  # one scalar
    log = kv_read_log(spark, log_path)
    newer = log.where(F.col(BATCH) > F.lit(-1 if last is None else last))
    if cells is None:
        cells = [c for c in snap.columns if c not in (key, *order_cols, BATCH)]
    cols = [key, *dict.fromkeys([*order_cols, BATCH]), *cells]
    both = snap.select(*cols).unionByName(newer.select(*cols))
    return kv_current(both, key, order_cols, cells)


def day_of(key: Column) -> Column:
    """The day of a ``yyyy-MM-dd HH:mm:ss`` key, as text; keys that don't begin with a day share one of their own."""
    return F.when(key.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(key, 1, 10)).otherwise(F.lit(OTHER_DAY))


def with_day(kv: DataFrame, key: str = "key", day_col: str = DAY) -> DataFrame:
    """Add the key's day as a partition column."""
    return kv.withColumn(day_col, day_of(F.col(key)))


def kv_write_by_day(kv: DataFrame, path: str, key: str = "key", day_col: str = DAY) -> None:
    """Write a keyed table partitioned by the key's day, for pruned range scans."""
    with_day(kv, key, day_col).write.mode("overwrite").partitionBy(day_col).parquet(path)


def in_days(day: Column, start: str, stop: str) -> Column:
    """Whether a key of this day may lie in ``start <= key < stop``."""
    text = day.cast("string")
    return day.isNotNull() & (text.between(F.lit(start[:10]), F.lit(stop[:10])) | (text == F.lit(OTHER_DAY)))


def range_scan(
    kv: DataFrame, start: str, stop: str, key: str = "key", partition_col: str | None = None
) -> DataFrame:
    """Rows with ``start <= key < stop`` (start inclusive, stop exclusive).

    With ``partition_col`` (the key's day, which the table or the log under it
    is partitioned by), the same bounds prune whole partitions before any file
    is read; keys without a readable day are always looked at.
    """
    cond = (F.col(key) >= F.lit(start)) & (F.col(key) < F.lit(stop))
    if partition_col:
        cond = cond & in_days(F.col(partition_col), start, stop)
    return kv.where(cond)


def latest_run(predictions: DataFrame, ts: str = "ts", value: str = "predicted_load_mw", run_col: str = "run_id") -> DataFrame:
    """(ts, value) of the latest run per ts; the larger value on a tie."""
    last = [F.col(c) for c in (run_col, value) if c in predictions.columns]
    return predictions.groupBy(ts).agg(F.max(F.struct(*last))[value].alias(value))


def export_latest(
    predictions: DataFrame,
    n: int = 24,
    zone: str = DEFAULT_ZONE,
    ts: str = "ts",
    value: str = "predicted_load_mw",
    run_col: str = "run_id",
) -> DataFrame:
    """Latest ``n`` prediction rows by ts as (row_key, prediction_value, prediction_ts).

    One row per hour, as the keyed store would keep: the latest run's (if there
    is a run column; the larger value on a tie), so repeated runs cannot crowd
    hours out.  Top-n plans as TakeOrderedAndProject: each partition
    keeps its own n best rows, only those are merged.
    """
    top = latest_run(predictions, ts, value, run_col).select(ts, value).orderBy(F.col(ts).desc(), F.col(value).desc()).limit(n)
    return top.select(
        format_key(ts).alias("row_key"),
        F.col(value).alias("prediction_value"),
        epoch_seconds(ts, zone).alias("prediction_ts"),
    )
