"""Shared pieces of the training-data operators: folds, scratch tables, vectorised text scanning.

Words are ``[^\\x20\\x09-\\x0D]+``.  The numpy helpers work on the raw UTF-8
buffer of an Arrow string array, a bounded chunk at a time, so that no Python
object is made per word.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.session import scratch_path

# The word pattern of all operators, as Java and RE2 read it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that the numpy helpers look at together (a longer text is taken alone).
CHUNK_BYTES = 1 << 19


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder and read it back.

    Cuts the lineage: what follows reads files that survive a lost executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` (for mapInArrow); once its rows are through, what it has freed goes back to the system.

    Spark keeps a Python worker for later tasks; else it would hold the most that any
    task needed, beside the executor's heap, while stages without Python run.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    return released


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# ---------------------------------------------------------------- numpy text scanning

_M64 = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
_PINV = pow(_P, -1, 1 << 64)
_Q = 0xD1342543DE82EF95 | 1
_QINV = pow(_Q, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): close inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 2 * CHUNK_BYTES:  # the powers for a very long text aren't kept
            _POWERS[base] = have
    return have[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _P, inverse: int = _PINV) -> np.ndarray:
    """64-bit polynomial hash of ``values[start:end]`` for all ranges at once."""
    n = len(values)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, n), out=total[1:])
    raw = (total[ends] - total[starts]) * _powers(inverse, n + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def gram_hash(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring words (``len - n + 1`` of them)."""
    count = max(0, len(word_hash) - n + 1)
    starts = np.arange(count)
    return range_hash(word_hash, starts, starts + n, _Q, _QINV)


class Words:
    """Words of a chunk of texts.

    data      uint8 of all texts, one after the other; ``offsets[i]:offsets[i+1]`` is text i
    start/end byte range of each word in ``data``
    first     ``first[i]:first[i+1]`` are the words of text i
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.space = _SPACE[data]
        n = len(data)
        if n:
            begins = np.empty(n, dtype=bool)
            begins[0] = True
            begins[1:] = self.space[:-1]
            inner = offsets[:-1][offsets[:-1] < n]
            begins[inner] = True
            finishes = np.empty(n, dtype=bool)
            finishes[-1] = True
            finishes[:-1] = self.space[1:]
            finishes[inner[inner > 0] - 1] = True
            word = ~self.space
            self.start = np.flatnonzero(word & begins)
            self.end = np.flatnonzero(word & finishes) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        return range_hash(_BYTE[self.data], self.start, self.end)

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def of_text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.count())

    def joined(self, i: int, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi`` of text i (as many as it has), joined by one space."""
        at = slice(self.first[i] + lo, min(self.first[i] + hi, self.first[i + 1]))
        return b" ".join(bytes(self.data[s:e]) for s, e in zip(self.start[at], self.end[at], strict=True))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    _, off, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of about ``limit`` bytes."""
    data, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + (1 << 16))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``bounds``."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return np.diff(total[bounds])
