"""Substring deduplication by super-k-mers.

A window is ``WINDOW`` consecutive words of a document.  A word is removed if a
window covers it whose word sequence also starts in a document with a smaller
id.

1. Every window has a minimiser, the least hash of the ``MINIMISER``-word runs
   in it.  Consecutive windows that share it are one super-k-mer.  Equal
   windows have equal minimisers, so a minimiser that only one document has
   needs no further look: (minimiser, document, place) rows find the others.
2. The super-k-mers left travel as one packed string each, to the bucket of
   their minimiser.  There the windows of all strings are ranked by repeated
   sorting (runs of 1, 2, 4, ... 32 words, then the window as two runs), and
   every window whose least document is smaller marks its words.
3. A minimiser with more than ``HOT`` super-k-mers would make too large a
   bucket: its windows go one by one, by digest, and meet in an aggregate that
   is combined before the shuffle.
4. The marked ranges go back to their documents.

Words are told apart by 64-bit hashes.  Defined results: a null or empty text
has no words; a text shorter than a window loses nothing; a document without
an id has no smaller one and is no smaller one; rows with equal ids are told
apart by their text, and neither is smaller; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, gram_hash, materialize, shuffle_partitions

WINDOW = 50
MINIMISER = 8
#: Super-k-mers of one minimiser that may meet in one bucket.
HOT = 20_000
#: Words that are ranked together, about (more, if one minimiser has more).
_RANKED = 1 << 18


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def super_kmers(word_hash: np.ndarray, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows) of the runs of windows that share a minimiser."""
    if len(word_hash) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = sliding_minimum(gram_hash(word_hash, minimiser), window - minimiser + 1).view(np.int64)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first], first, np.diff(np.append(first, len(least)))


def _find(window: int, minimiser: int):
    """Super-k-mers of each text, without their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            rows: list[np.ndarray] = []
            for lo, hi, data, offsets in chunks(batch.column(2)):
                words = Words(data, offsets)
                hashes = words.hashes()
                for i in np.flatnonzero(words.count() >= window):
                    found = super_kmers(hashes[words.first[i] : words.first[i + 1]], window, minimiser)
                    parts.append(found)
                    rows.append(np.full(len(found[0]), lo + i))
            if parts:
                mini, first, count = (np.concatenate(x) for x in zip(*parts, strict=True))
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(mini), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["dk", "doc_id", "mini", "first", "windows"],
                )

    return run


def _pack(window: int):
    """The words of the super-k-mers asked for, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dk, doc_id, texts, seats = (c.to_pylist() for c in batch.columns)
            out: list[tuple] = []
            size = 0
            for d, i, text, wanted in zip(dk, doc_id, texts, seats, strict=True):
                words = text.encode().split()  # splits bytes at white space of ASCII, as the word pattern does
                for s in wanted:
                    out.append((s["mini"], i, d, s["first"], b" ".join(words[s["first"] : s["first"] + s["windows"] + window - 1])))
                    size += len(out[-1][-1])
                if size > 8 << 20:
                    yield _packed(out)
                    out, size = [], 0
            if out:
                yield _packed(out)

    return run


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["mini", "doc_id", "dk", "first", "packed"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def window_ranks(word_hash: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` words a number that equal runs share, and no others."""

    def rank(x: np.ndarray) -> np.ndarray:
        return np.unique(x, return_inverse=True)[1].astype(np.uint64)

    out, span = rank(word_hash), 1
    while 2 * span <= window:
        out = rank(out[:-span] << np.uint64(32) | out[span:])
        span *= 2
    rest = window - span
    return rank(out[: len(out) - rest] << np.uint64(32) | out[rest:]) if rest else out


def marked_ranges(packed: list[bytes], doc_id: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
    """(string, first word, word after the last) of words whose window starts in a smaller document, too."""
    lengths = np.array([len(p) + 1 for p in packed])
    data = np.frombuffer(b" ".join(packed) + b" ", dtype=np.uint8)
    words = Words(data, np.concatenate([[0], np.cumsum(lengths)]))
    ranks = window_ranks(words.hashes(), window)
    owner = words.of_text()
    inside = np.flatnonzero(owner[: len(ranks)] == owner[window - 1 :])  # windows of one string
    rank, owner = ranks[inside].astype(np.int64), owner[inside]
    least = np.full(int(rank.max()) + 1 if len(rank) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, rank, doc_id[owner])
    marked = inside[doc_id[owner] > least[rank]]
    if not len(marked):
        return
    owner = words.of_text()[marked]
    place = marked - words.first[owner]
    breaks = np.flatnonzero((np.diff(marked) != 1) | (np.diff(owner) != 0)) + 1
    for a, b in zip([0, *breaks], [*breaks, len(marked)], strict=True):
        yield int(owner[a]), int(place[a]), int(place[b - 1]) + window


def _count(window: int):
    def ranges(rows: list[tuple]) -> pa.RecordBatch:
        found = list(marked_ranges([r[4] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), window))
        dk = [rows[i][2] for i, _, _ in found]
        lo, hi = [rows[i][3] + a for i, a, _ in found], [rows[i][3] + b for i, _, b in found]
        return pa.RecordBatch.from_arrays([pa.array(dk, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["dk", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= _RANKED and row[0] != rows[-1][0]:
                    yield ranges(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4]) // 6
        if rows:
            yield ranges(rows)

    return run


def _windows(window: int):
    """Single windows of hot minimisers, by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pack(window)(batches):
            _, doc_id, dk, first, packed = (c.to_pylist() for c in batch.columns)
            rows = []
            for i, d, f, p in zip(doc_id, dk, first, packed, strict=True):
                words = p.split(b" ")
                for k in range(len(words) - window + 1):
                    rows.append((hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=16).digest(), i, d, f + k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.binary(), pa.int64(), pa.int64(), pa.int32()], strict=True)],
                names=["digest", "doc_id", "dk", "lo"],
            )

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, ranges) -> (doc_id, n_words, n_removed, kept)."""
    for batch in batches:
        doc_id, texts, ranges = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        total, removed, kept = [], [], []
        for text, marks in zip(texts, ranges, strict=True):
            words = (text.as_py() or "").encode().split()
            total.append(len(words))
            if marks:
                keep = np.ones(len(words), dtype=bool)
                for m in marks:
                    keep[m["lo"] : m["hi"]] = False
                words = [words[i] for i in np.flatnonzero(keep)]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [doc_id, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   minimiser: int = MINIMISER, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) of every row."""
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(
        F.xxhash64(F.lit(17), F.col(doc_id), F.col(text)).alias("dk"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    found = materialize(
        rows.where(F.col("doc_id").isNotNull()).mapInArrow(_find(window, minimiser), "dk long, doc_id long, mini long, first int, windows int"),
        "superkmers",
    )
    shared = (
        found.groupBy("mini")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"), F.sum(F.col("windows").cast("long")).alias("sum"))
        .where(F.col("low") < F.col("high"))
        # many super-k-mers, or few that are long (of periodic text): what would meet in one list
        .select("mini", ((F.col("n") > hot) | (F.col("sum") > hot * window)).alias("hot"))
    )
    seats = materialize(
        found.join(shared, "mini")
        .groupBy("dk", "hot")
        .agg(F.collect_set(F.struct("mini", "first", "windows")).alias("seats")),  # at most one for each word of the document
        "superkmer-seats",
    )

    def asked(is_hot: bool) -> DataFrame:
        wanted = seats.where(F.col("hot") if is_hot else ~F.col("hot")).drop("hot")
        return rows.join(wanted, "dk").dropDuplicates(["dk"]).select("dk", "doc_id", "text", "seats")

    packed = asked(False).mapInArrow(_pack(window), "mini long, doc_id long, dk long, first int, packed binary")
    cold = packed.repartition(parts, "mini").sortWithinPartitions("mini").mapInArrow(_count(window), "dk long, lo int, hi int")
    single = asked(True).mapInArrow(_windows(window), "digest binary, doc_id long, dk long, lo int")
    least = single.groupBy("digest").agg(F.min("doc_id").alias("least"))
    met = single.join(least, "digest").where(F.col("doc_id") > F.col("least"))
    ranges = cold.union(met.select("dk", "lo", (F.col("lo") + window).alias("hi")))
    marks = ranges.groupBy("dk").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return rows.join(marks, "dk", "left").select("doc_id", "text", "ranges").mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept string"
    )
