"""Time-ordered train/test split on a distributed row number.

The reference takes ``limit(int(0.8 * n))`` of a ts-sorted frame as train and
``exceptAll`` for test.  A large limit gathers the rows into one task, and
``exceptAll`` hashes whole rows.  Here the rows get a global number once
(``with_sequence``) and the split is a filter on it: the same rows, fully
parallel.  ``exceptAll`` remains available as a check.

A frame that kept the number its windows were computed over (``rn``, which may
have gaps) isn't numbered again: rows are counted per stretch of numbers, and
only the stretch that the cut falls into is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.operators.features import default_tie_break
from loadcast.operators.sequence import with_sequence


#: Row numbers of a stretch that are counted together.
STRETCH = 1 << 20


def numbered(df: DataFrame, order: Sequence[str] = ("ts",), tie_break: Sequence[str] | None = None) -> DataFrame:
    ties = list(default_tie_break(df, order) if tie_break is None else tie_break)
    return with_sequence(df, [*order, *ties], rn_col="_rn")


def split_cut(n: int, ratio: float) -> int:
    """Rows in train: ``int(ratio * n)``, as the reference computes it."""
    return int(ratio * n)


def first_test_number(df: DataFrame, ratio: float, rn: str, stretch: int = STRETCH) -> int | None:
    """The number ``rn`` of the first row behind the first ``int(ratio*n)``; None if there is none.

    One row per stretch is summed up in order; one number comes to the driver.
    """
    home = F.expr(f"`{rn}` div {int(stretch)}")
    before = Window.orderBy("_home").rowsBetween(Window.unboundedPreceding, -1)
    placed = df.groupBy(home.alias("_home")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_home", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_total")
    )
    cut = F.floor(F.lit(float(ratio)) * F.col("_total"))
    row = placed.where((F.col("_before") <= cut) & (cut < F.col("_before") + F.col("_n"))).select("_home", "_before", "_total").first()
    if row is None:
        return None
    skip = split_cut(row["_total"], ratio) - row["_before"]  # less than a stretch
    return df.where(home == row["_home"]).select(rn).orderBy(rn).offset(skip).limit(1).first()[0]


def mark_test(
    df: DataFrame,
    ratio: float = 0.8,
    order: Sequence[str] = ("ts",),
    tie_break: Sequence[str] | None = None,
    rn: str | None = None,
    flag: str = "_test",
) -> DataFrame:
    """``df`` without ``rn`` and with a column ``flag``: false for the first ``int(ratio*n)`` rows in
    time order, true for the rest.

    ``rn``: a column of ``df`` that already numbers the rows in that order, if there is one.
    """
    if rn is None:
        seq = numbered(df, order, tie_break)
        cut = split_cut(seq.count(), ratio)  # one scalar to the driver
        return seq.withColumn(flag, F.col("_rn") >= cut).drop("_rn")
    first = first_test_number(df, ratio, rn)
    return df.withColumn(flag, F.lit(False) if first is None else F.col(rn) >= first).drop(rn)


def time_split(
    df: DataFrame,
    ratio: float = 0.8,
    order: Sequence[str] = ("ts",),
    tie_break: Sequence[str] | None = None,
    rn: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first ``int(ratio*n)`` rows in time order, and the rest."""
    marked = mark_test(df, ratio, order, tie_break, rn)
    return marked.where(~F.col("_test")).drop("_test"), marked.where("_test").drop("_test")


def time_split_with_bounds(
    df: DataFrame, ratio: float = 0.8, order: Sequence[str] = ("ts",), tie_break: Sequence[str] | None = None,
    rn: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``time_split`` plus its bounds row, computed in one pass over the numbered rows."""
    marked = mark_test(df, ratio, order, tie_break, rn)
    is_train = ~F.col("_test")
    ts = F.col(order[0])
    bounds = marked.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_train).alias("train_rows"),
        F.count_if(~is_train).alias("test_rows"),
        F.max(F.when(is_train, ts)).alias("train_max_ts"),
        F.min(F.when(~is_train, ts)).alias("test_min_ts"),
    ).withColumn("ordered", F.coalesce(F.col("train_max_ts") <= F.col("test_min_ts"), F.lit(True)))
    return marked.where(is_train).drop("_test"), marked.where(~is_train).drop("_test"), bounds


def split_bounds(train: DataFrame, test: DataFrame, ts: str = "ts") -> DataFrame:
    """One row: sizes and the boundary timestamps, plus whether they are ordered."""
    both = train.select(F.lit("train").alias("_s"), F.col(ts)).unionByName(
        test.select(F.lit("test").alias("_s"), F.col(ts))
    )
    is_train = F.col("_s") == "train"
    agg = both.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_train).alias("train_rows"),
        F.count_if(~is_train).alias("test_rows"),
        F.max(F.when(is_train, F.col(ts))).alias("train_max_ts"),
        F.min(F.when(~is_train, F.col(ts))).alias("test_min_ts"),
    )
    return agg.withColumn(
        "ordered",
        F.coalesce(F.col("train_max_ts") <= F.col("test_min_ts"), F.lit(True)),
    )


def test_by_except_all(df: DataFrame, train: DataFrame) -> DataFrame:
    """The reference's test set: every row of ``df`` not in ``train`` (multiset)."""
    return df.exceptAll(train)


def first_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The first ``n`` rows in time order (a preview; plans as a top-k)."""
    return df.orderBy(*order).limit(n)


def time_folds(df: DataFrame, k: int, fold_col: str = "fold", order: Sequence[str] = ("ts",)) -> DataFrame:
    """Add ``fold_col`` = 0..k-1 as contiguous blocks of the time order.

    For ``CrossValidator(foldCol=...)``: each validation fold is one time
    block instead of a random sample of hours.
    """
    seq = numbered(df, order)
    n = seq.count()
    return seq.withColumn(fold_col, F.expr(f"cast((_rn * {int(k)}) div {max(n, 1)} as int)")).drop("_rn")


def assert_split_ordered(train: DataFrame, test: DataFrame, ts: str = "ts") -> DataFrame:
    """Fail unless every train row precedes every test row; returns the bounds row."""
    bounds = split_bounds(train, test, ts)
    row = bounds.first()
    if not row["ordered"]:
        raise AssertionError(f"train ends {row['train_max_ts']} after test starts {row['test_min_ts']}")
    return bounds
