"""Global row numbering and halo-blocked windows over an ordered series.

``LAG(x, k) OVER (ORDER BY ts)`` without PARTITION BY plans as an exchange
into a single partition: the whole series lands in one task.  Because every
window the reference uses reaches back a bounded number of rows, the series
can instead be cut into blocks of ``block`` consecutive rows; each block
gets a copy of the last ``reach`` rows of the block before it (its halo), the
windows run per block in parallel, and halo rows are dropped afterwards.
The result is identical to the global window.

Numbering (``with_sequence``):
  1. range-partition on (series keys, order keys) -- Spark samples the
     composite key, so a hot series or a hot timestamp is split across
     partitions -- and sort within partitions;
  2. tag rows with ``monotonically_increasing_id`` = (partition, position);
  3. write the tagged rows once below ``spark.checkpoint.dir``: this fixes
     the numbering, so a lost executor or a second read cannot re-sample
     different range bounds;
  4. count rows per (partition, series) -- a table with at most
     partitions + series rows -- and turn the counts into prefix offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadcast.session import scratch_path, target_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1

DEFAULT_BLOCK = 16384

# Helper columns these operators add and drop again; an input must not carry them.
_RESERVED_SEQ = {"_salt", "_mid", "_pid", "_loc", "_opid", "_first", "_off", "_n"}
_RESERVED_HALO = {"_blk", "_home"}


def _check_reserved(df: DataFrame, reserved: set[str]) -> None:
    clash = reserved.intersection(df.columns)
    if clash:
        raise ValueError(f"input columns {sorted(clash)} are reserved by the operator; rename them")


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


class Staged:
    """A window feature computed in two passes over the same window spec.

    ``helpers`` are evaluated first (e.g. running sums); ``final`` may then use
    them (e.g. lags of the running sums).  Both passes share partitioning and
    ordering, so the second adds no exchange and no sort.
    """

    def __init__(self, helpers: dict[str, Callable[[WindowSpec], Column]], final: Callable[[WindowSpec], Column]):
        self.helpers = helpers
        self.final = final


def apply_windows(df: DataFrame, features: dict, w: WindowSpec) -> DataFrame:
    """Add every feature (plain ``fn(w)`` or ``Staged``) evaluated over ``w``."""
    helpers: dict[str, Callable[[WindowSpec], Column]] = {}
    for f in features.values():
        if isinstance(f, Staged):
            helpers.update(f.helpers)
    if helpers:
        df = df.select("*", *[fn(w).alias(n) for n, fn in helpers.items()])
    finals = [(f.final if isinstance(f, Staged) else f)(w).alias(name) for name, f in features.items()]
    return df.select("*", *finals).drop(*helpers)


def with_sequence(
    df: DataFrame,
    order_cols: Sequence[str],
    series_keys: Sequence[str] = (),
    rn_col: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 0-based row number ``rn_col`` in ``order_cols`` order (per series).

    ``order_cols`` should be a total order (add tie-break columns); rows that
    tie on every column are interchangeable, so results stay deterministic.
    Nulls sort first, as in Spark SQL's ascending order.
    """
    return sized_sequence(df, order_cols, series_keys, rn_col, num_partitions)[0]


def sized_sequence(
    df: DataFrame,
    order_cols: Sequence[str],
    series_keys: Sequence[str] = (),
    rn_col: str = "rn",
    num_partitions: int | None = None,
    size_col: str | None = None,
) -> tuple[DataFrame, int | None]:
    """``with_sequence`` plus a partition count sized from the written table
    (a plain Parquet scan, whose size Spark knows exactly), for the exchange
    that follows.  With ``size_col`` each row also gets its series' number of rows."""
    _check_reserved(df, _RESERVED_SEQ)
    spark = df.sparkSession
    n = num_partitions or target_partitions(df)
    # A last, unique tie-break: rows equal in every column would otherwise share
    # one sort key, which the range partitioner cannot split (a hot duplicate).
    # Such rows are interchangeable, so the numbering's results do not change.
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    keys = [*series_keys, *order_cols, "_salt"]
    ranged = salted.repartitionByRange(n, *keys) if n else salted.repartitionByRange(*keys)
    tagged = (
        ranged.sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .drop("_salt")
    )
    path = scratch_path(spark, "sequence")
    tagged.write.parquet(path)
    written = spark.read.parquet(path)
    sized = target_partitions(written)
    fixed = (
        written
        .withColumn("_pid", F.shiftrightunsigned("_mid", _LOCAL_BITS))
        .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
        .drop("_mid")
    )

    counts = fixed.groupBy("_pid", *series_keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first")
    )
    before = Window.partitionBy(*series_keys).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    renamed = {k: f"_o_{i}" for i, k in enumerate(series_keys)}
    offsets = counts.select(
        F.col("_pid").alias("_opid"),
        *[F.col(k).alias(v) for k, v in renamed.items()],
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        *([F.sum("_n").over(Window.partitionBy(*series_keys)).alias(size_col)] if size_col else []),
    )
    if not series_keys:
        # One row per range partition: bounded by the partition count, not by the data.
        offsets = F.broadcast(offsets)
    cond = F.col("_pid") == F.col("_opid")
    for k, v in renamed.items():
        cond = cond & F.col(k).eqNullSafe(F.col(v))  # a null series is a series too
    out = (
        fixed.join(offsets, cond)
        .withColumn(rn_col, F.col("_off") + F.col("_loc") - F.col("_first"))
        .drop("_pid", "_opid", "_loc", "_off", "_first", *renamed.values())
    )
    return out, sized


def halo_windows(
    seq: DataFrame,
    features: dict[str, Callable[[WindowSpec], Column]],
    reach: int,
    block: int = DEFAULT_BLOCK,
    series_keys: Sequence[str] = (),
    rn_col: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """Evaluate row-window ``features`` over numbered rows, block by block.

    ``features`` maps an output name to ``fn(w)`` where ``w`` is the window
    ordered by ``rn_col`` (use ``lag`` or ``rowsBetween(-k, 0)`` frames with
    k <= ``reach``).  One extra shuffle on (series, block); each task holds
    at most ``block + reach`` rows per block.
    """
    if block < max(reach, 1):
        raise ValueError(f"block ({block}) must be at least reach ({reach})")
    _check_reserved(seq, _RESERVED_HALO)
    rn = F.col(rn_col)
    blk = F.expr(f"`{rn_col}` div {int(block)}")
    in_tail = (rn % F.lit(block)) >= F.lit(block - reach) if reach > 0 else F.lit(False)
    # Each row lands in its own block; rows in a block's tail are also copied
    # into the next block as halo.  One pass (generate), no second scan.
    copies = F.when(in_tail, F.array(blk, blk + 1)).otherwise(F.array(blk))
    spread = seq.withColumn("_home", blk).withColumn("_blk", F.explode(copies))
    if num_partitions:
        # Size the block exchange to the data; the window reuses this partitioning.
        spread = spread.repartition(num_partitions, *series_keys, "_blk")
    w = Window.partitionBy(*series_keys, "_blk").orderBy(rn_col)
    out = apply_windows(spread, features, w)
    return out.where(F.col("_blk") == F.col("_home")).drop("_blk", "_home")


def global_windows(
    df: DataFrame,
    features: dict[str, Callable[[WindowSpec], Column]],
    order_cols: Sequence[str],
    series_keys: Sequence[str] = (),
) -> DataFrame:
    """The plain window form, for small inputs and as the test reference."""
    w = Window.partitionBy(*series_keys).orderBy(*_cols(order_cols))
    return apply_windows(df, features, w)
