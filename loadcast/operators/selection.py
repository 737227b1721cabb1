"""Time-ordered cuts of a table by selection: no sort of the table, no numbered copy.

The row that ``int(ratio * n)`` rows come before is found by histograms over
the time: rows are counted per range (a power of two wide, at most ``RANGES``
of them), and the next round looks only into the range with the cut.  A range of few
rows, or a single instant, ends the search; rows of one instant are ordered by a
hash of the whole row, found alike.  A round reads one column and brings a bounded
number of counts to the driver; there are at most six rounds, two for hourly data.

Rows order: null times first, then by time, then by the row's hash.  Rows alike
in all columns are interchangeable: a cut among them gives each side its number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of a round, and rows that are few enough to be looked at one by one.
RANGES, FEW = 4096, 4096
_NULL = -(2**63)


@dataclass(frozen=True)
class Cut:
    """The first row behind a cut: its time, its hash (None: the only row of its time) and how many
    of the rows of both come before the cut."""

    time: int
    hash: int | None = None
    copies: int = 0


def _number(df: DataFrame, name: str) -> Column:
    """A time or integer column as a long of the same order, null first."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):  # no zone, so no hour counts twice
        value = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(c)
    elif isinstance(kind, T.DateType):
        value = F.unix_date(c)
    elif isinstance(kind, T.IntegralType):
        value = c
    else:
        raise TypeError(f"{name} is {kind.simpleString()}, not a time")
    return F.coalesce(value.cast("long"), F.lit(_NULL))


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def select_number(rows: DataFrame, k: int, low: int, high: int) -> tuple[int, int, int]:
    """The ``k``-th smallest of the longs ``v`` (from 0, all between low and high), how many are smaller, how many equal it."""
    before, equal = 0, None
    v = F.col("v")
    while low < high:
        shift = max(0, (high - low).bit_length() - (RANGES.bit_length() - 1))
        inside = rows.where(v.between(low, high))
        counts = sorted(tuple(r) for r in inside.groupBy(F.shiftright("v", shift).alias("range")).agg(F.count(F.lit(1)).alias("n")).collect())
        for part, n in counts:
            if before + n > k:
                break
            before += n
        low, high, equal = max(low, part << shift), min(high, ((part + 1) << shift) - 1), n
        if low < high and n <= FEW:
            values = sorted(r["v"] for r in rows.where(v.between(low, high)).collect())
            found = values[k - before]
            return found, before + values.index(found), values.count(found)
    return low, before, equal if equal is not None else rows.count()


def find_cuts(df: DataFrame, places: Sequence[int] | Sequence[float], time: str = "ts") -> tuple[int, list[Cut | None]]:
    """(number of rows, the cut before each place); a float is a share of the rows.  None: no row is behind it."""
    times = df.select(_number(df, time).alias("v"))
    seen = times.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    cuts: list[Cut | None] = []
    for place in places:
        k = int(place * seen["n"]) if isinstance(place, float) else place
        if k >= seen["n"]:
            cuts.append(None)
            continue
        value, before, equal = select_number(times, k, seen["low"], seen["high"])
        if equal == 1:
            cuts.append(Cut(value))
            continue
        same = df.where(_number(df, time) == value).select(_row_hash(df).alias("v"))
        edge = same.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
        h, earlier, _ = select_number(same, k - before, edge["low"], edge["high"])
        cuts.append(Cut(value, h, k - before - earlier))
    return seen["n"], cuts


def behind(df: DataFrame, cut: Cut | None, time: str = "ts") -> Column:
    """Whether a row is behind the cut; rows alike in time and hash are, all of them."""
    if cut is None:
        return F.lit(False)
    v = _number(df, time)
    if cut.hash is None:
        return v >= cut.time
    return (v > cut.time) | ((v == cut.time) & (_row_hash(df) >= cut.hash))


def split_at(df: DataFrame, cut: Cut | None, time: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(rows before the cut, rows behind it)."""
    late = behind(df, cut, time)
    if cut is None or not cut.copies:
        return df.where(~late), df.where(late)
    # the cut falls among rows alike: as many copies of them as it takes
    twins = (_number(df, time) == cut.time) & (_row_hash(df) == cut.hash)
    kinds = df.where(twins).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))  # one, unless hashes collide
    upto = Window.orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)
    kinds = kinds.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    early = F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(cut.copies) - F.col("_before")))

    def copies(number: Column) -> DataFrame:
        some = kinds.withColumn("_k", number.cast("long")).where(F.col("_k") > 0)
        return some.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k")))).select(*df.columns)

    return df.where(~late).unionByName(copies(early)), df.where(late & ~twins).unionByName(copies(F.col("_n") - early))


def select_split(df: DataFrame, ratio: float = 0.8, time: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(train, test): the first ``int(ratio * n)`` rows in time order, and the rest."""
    _, (cut,) = find_cuts(df, [float(ratio)], time)
    return split_at(df, cut, time)


def forward_folds(df: DataFrame, folds: int = 3, time: str = "ts") -> list[tuple[DataFrame, DataFrame]]:
    """(train, validate) of each fold: time is cut into ``folds`` + 1 blocks of equal size; fold i trains on
    all blocks before block i and validates on block i, so nothing is learned from the future."""
    if folds < 1:
        raise ValueError("at least one fold")
    _, cuts = find_cuts(df, [i / (folds + 1) for i in range(1, folds + 1)], time)
    late = [behind(df, cut, time) for cut in cuts] + [F.lit(False)]
    return [(df.where(~late[i]), df.where(late[i] & ~late[i + 1])) for i in range(folds)]
