"""Periodic runs of words, found by minimisers on several scales.

A run is a stretch of consecutive words whose words ``q`` apart are identical,
``q`` its smallest period, at least ``max(MIN_WORDS, MIN_REPEATS * q)`` words
long, and as long as it can be.

Periods up to ``DIRECT`` are found by comparing the words with themselves,
``q`` places on.  Scale W (DIRECT, then its doubles) finds the periods from
W + 1 to 2 W.  It hashes all stretches of 2 W words and takes the minimum of
every W neighbouring hashes.  Inside a run the minima repeat a period on, and as
2 W words are a whole period or more, equal stretches of a run are never less
than a period apart: neighbouring equal minima are exactly a period apart.  A run
holds W + 2 W + q words and more (3 W < 3 q), so at least one such pair; each is
a seed, whose period is then extended word by word to both sides.  A scale reads
only the texts that are long enough for it, and gathers about 2 / W of their
places, so all scales together are linear in the words but for their sorting.

Words are told apart by 64-bit hashes.  Defined results: a null, empty or
blank text has no runs and becomes an empty text; a text is looked at by
itself, repeated rows and ids row by row; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, chunks, gram_hash, mix

MIN_WORDS, MIN_REPEATS = 6, 4
#: Periods up to this many words are compared directly (two at least).
DIRECT = 8

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def _sliding(best: np.ufunc, values: np.ndarray, width: int, pad: int) -> np.ndarray:
    """``best`` of every ``width`` neighbours, by running bests from either end of blocks of that width."""
    n = len(values)
    blocks = np.append(values, np.full(-n % width, pad, dtype=values.dtype)).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def minimisers(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the values that are the least of some ``width`` neighbours (all of equal ones)."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    least = _sliding(np.minimum, values, width, np.iinfo(np.uint64).max)
    edge = np.zeros(width - 1, dtype=values.dtype)
    most = _sliding(np.maximum, np.concatenate([edge, least, edge]), width, 0)
    return np.flatnonzero(most == values)


def _agreeing(values: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on (or back, if step is -1) hold the value that stands ``lag`` later."""
    limit = len(values) - lag - at if step > 0 else at + 1
    done, size = 0, 64
    while done < limit:
        size = min(2 * size, limit - done)
        lo = at + done if step > 0 else at - done - size + 1
        other = np.flatnonzero(values[lo : lo + size] != values[lo + lag : lo + lag + size])
        if len(other):
            return done + (int(other[0]) if step > 0 else size - 1 - int(other[-1]))
        done += size
    return done


def _is_smallest(values: np.ndarray, start: int, period: int) -> bool:
    """Whether a run of two periods or more from ``start`` has no smaller period (it would divide this one)."""
    rest, divisor = period, 2
    primes = []
    while divisor * divisor <= rest:
        if rest % divisor == 0:
            primes.append(divisor)
            while rest % divisor == 0:
                rest //= divisor
        divisor += 1
    primes += [rest] if rest > 1 else []
    twice = values[start : start + 2 * period]
    return not any(np.array_equal(twice[: -period // p], twice[period // p :]) for p in primes)


def find_runs(values: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """(start, length, period) rows of all runs of a chunk, by start and period.

    ``values``: a number per word; a text ends with a value that no other
    place holds, and ``texts`` gives the length of each, that value included.
    """
    found: set[tuple[int, int, int]] = set()
    for q in range(1, DIRECT + 1):
        same = np.flatnonzero(values[:-q] == values[q:])
        if len(same) == 0:
            continue
        cut = np.flatnonzero(np.diff(same) > 1)
        lo, hi = same[np.append(0, cut + 1)], same[np.append(cut, len(same) - 1)]
        length = hi - lo + 1 + q
        long = length >= max(MIN_WORDS, MIN_REPEATS * q)
        found.update((s, n, q) for s, n in zip(lo[long].tolist(), length[long].tolist(), strict=True) if _is_smallest(values, s, q))
    width = DIRECT
    place = np.arange(len(values))
    while True:
        enough = texts > max(MIN_WORDS, MIN_REPEATS * (width + 1))
        if not enough.any():
            break
        if not enough.all():
            keep = np.repeat(enough, texts)
            values, place, texts = values[keep], place[keep], texts[enough]
        found.update((int(place[s]), n, q) for s, n, q in _scale(values, width))
        width *= 2
    rows = np.array(sorted((s, q, n) for s, n, q in found), dtype=np.int64).reshape(-1, 3)
    return rows[:, [0, 2, 1]]


def _scale(values: np.ndarray, width: int) -> Iterator[tuple[int, int, int]]:
    """The runs with a period from ``width`` + 1 to 2 ``width``."""
    hashes = gram_hash(values, 2 * width)
    at = minimisers(hashes, width)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    lag = np.diff(at)
    seeds = np.flatnonzero((hashes[at[1:]] == hashes[at[:-1]]) & (lag > width) & (lag <= 2 * width))
    reached: dict[int, int] = {}  # per period: where its last run ends
    for i in seeds[np.argsort(at[seeds], kind="stable")]:
        m, q = int(at[i]), int(lag[i])
        if m + q < reached.get(q, 0):
            continue
        ahead = _agreeing(values, m, q, 1)
        start = m - _agreeing(values, m - 1, q, -1) if m else 0
        reached[q] = m + ahead + q
        length = reached[q] - start
        if length >= max(MIN_WORDS, MIN_REPEATS * q) and _is_smallest(values, start, q):
            yield start, length, q


def _scan(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], pa.Array]:
    """Runs of each text of a chunk, and the texts without the words that a run repeats."""
    words = Words(data, offsets)
    count = words.count()
    n_texts, n_words = len(count), len(words.start)
    ends = np.cumsum(count + 1) - 1  # a value of its own after each text
    values = np.empty(n_words + n_texts, dtype=np.uint64)
    is_word = np.ones(n_words + n_texts, dtype=bool)
    is_word[ends] = False
    values[is_word] = words.hashes()
    values[ends] = mix(np.arange(n_texts, dtype=np.uint64) + np.uint64(0xD6E8FEB86659FD93))
    runs = find_runs(values, count + 1)
    of_text = np.searchsorted(ends, runs[:, 0])
    change = np.zeros(n_words + n_texts + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero((np.cumsum(change)[:-1] == 0)[is_word])
    begin = (ends - count)[of_text]
    runs = runs - np.stack([begin, np.zeros_like(begin), np.zeros_like(begin)], axis=1) if len(runs) else runs
    per_text = np.split(runs, np.searchsorted(of_text, np.arange(1, n_texts)))

    # the kept words, each with a space after it; a text's last space is left out
    size = words.end[kept] - words.start[kept] + 1
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(size, dtype=np.int64)])
    source = np.repeat(words.start[kept] - total[:-1], size) + np.arange(total[-1])
    spaced = np.append(data, np.uint8(0x20))[source]
    spaced[total[1:] - 1] = 0x20
    bounds = total[np.searchsorted(kept, words.first)]
    some = np.flatnonzero(np.diff(bounds))
    last = np.ones(len(spaced), dtype=bool)
    last[bounds[some + 1] - 1] = False
    shorter = np.zeros(n_texts + 1, dtype=np.int64)
    shorter[some + 1] = 1
    text = pa.LargeStringArray.from_buffers(n_texts, pa.py_buffer((bounds - np.cumsum(shorter)).astype(np.int64)), pa.py_buffer(spaced[last]))
    return per_text, text.cast(pa.string())


def collapse(docs: DataFrame, text: str = "text", runs: str = "runs") -> DataFrame:
    """``docs`` with the words that runs repeat after their first period taken out of ``text``
    (those left are joined by one space), and ``runs``: (start, length, period) of every run by
    start and period, as word numbers of the text before.  ``runs`` must not be a column of ``docs``."""
    at = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.struct([pa.field(f, pa.int64(), False) for f in ("start", "length", "period")])
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(at)):
                per_text, shorter = _scan(data, offsets)
                sizes = np.concatenate([np.zeros(1, np.int32), np.cumsum([len(r) for r in per_text], dtype=np.int32)])
                flat = np.concatenate(per_text)
                rows = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(struct))
                columns = batch.slice(lo, hi - lo).columns
                columns[at] = shorter
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(sizes), rows)], names=[*batch.schema.names, runs])

    fields = [T.StructField(f.name, T.StringType()) if f.name == text else f for f in docs.schema.fields]
    return docs.mapInArrow(scan, T.StructType([*fields, T.StructField(runs, T.ArrayType(RUN, False), False)]))


def longest(runs: Column) -> Column:
    """The longest run (the first of equal ones, then that of the smallest period); null without runs."""
    key = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(key.isNotNull(), F.struct((-key["start"]).alias("start"), key["length"].alias("length"), (-key["period"]).alias("period")))


def listing(runs: Column) -> Column:
    """``start,length,period`` and a line feed of each run."""
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
