"""Language-model scoring by the subword lattice of a unigram vocabulary.

A word's probability is the sum over all its segmentations into vocabulary
pieces of the product of the pieces' probabilities, found by a forward
recursion in log space; a text is its words and one end.  The pieces are those
of an existing sentencepiece file (its path is a parameter; pieces with a white
space inside play no part) and all single bytes, so every word has a
segmentation.  The file's scores give the starting weights; expectation-
maximisation over the distinct words of all training documents re-estimates
them (the vocabulary stays as it is).

Besides, every word of the training documents is a piece of its own lattice,
weighed by its count less a discount; what the discounts leave, and no more, is
shared by the segmentations into the vocabulary's pieces.  So a word that was
seen scores by how often, one that wasn't by its spelling, and the
probabilities of all words and the end sum to 1.

Counts are corpus-wide: documents are dealt to groups of bounded text size,
each group gives its distinct words with training counts, words are summed over
the groups, and every group gets back one row per word of its own (count and
lattice score).  Neither the vocabulary of the corpus nor a group's texts are
ever in one place; a group's words stream by first, then its texts.

Defined results: a null text is empty; an empty text is one end; without
training documents all counts are 0 and the pieces keep their starting weights;
rows equal in id and text are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, buffers, chunks, materialize, shuffle_partitions

#: Bytes of text in a group, about.
GROUP_BYTES = 16 << 20
LEAST_GROUP_BYTES = 2 << 20
_SPACE = 0x20
#: Bytes of a word from which it is looked at by itself.
LONG = 256
_SLOT_BITS = 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str) -> dict[bytes, float]:
    """Pieces of a sentencepiece file as bytes (the word mark is a space), with starting weights.

    The files at hand have merge ranks for scores (0, -1, -2, ...); a rank r
    gets the Zipf weight 1 / (r + 2)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            out[piece] = 1.0 / (2.0 - model.get_score(i))
    return out


def with_bytes(pieces: dict[bytes, float]) -> dict[bytes, float]:
    """All single bytes besides; weights sum to 1."""
    least = min(pieces.values(), default=1.0)
    every = {bytes([b]): least for b in range(256)} | pieces
    total = sum(every.values())
    return {p: w / total for p, w in every.items()}


class Lattice:
    """Pieces and their weights; pieces are found by byte, byte pair, or a hash of their bytes.

    A beginning that no piece has ends the search from its place, so the work goes
    with the pieces that are there.  Words of equal length are looked at together;
    a word longer than ``LONG`` bytes by itself, all its places together.
    """

    def __init__(self, pieces: list[bytes], weight: np.ndarray):
        self.pieces, self.longest = pieces, max(map(len, pieces))
        self.weight, self.log = weight, np.log(weight)
        if self.longest * -self.log.min() > 600:
            raise ValueError("a piece is too long for its weight")  # a stretch of that many bytes has to stay a float
        self.single = np.full(256, -1, dtype=np.int32)
        self.pair, self.pair_goes_on = np.full(1 << 16, -1, dtype=np.int32), np.zeros(1 << 16, dtype=bool)
        entry: dict[bytes, int] = {}  # beginnings of three bytes and more: the piece, if it is one
        goes_on: set[bytes] = set()
        for i, p in enumerate(pieces):
            if len(p) == 1:
                self.single[p[0]] = i
            elif len(p) == 2:
                self.pair[p[0] << 8 | p[1]] = i
            else:
                entry[p] = i
                self.pair_goes_on[p[0] << 8 | p[1]] = True
                for n in range(len(p) - 1, 2, -1):
                    if p[:n] in goes_on:
                        break
                    goes_on.add(p[:n])
        names = sorted(entry.keys() | goes_on)
        codes = np.array([self._code(p) for p in names], dtype=np.uint64)
        if len(np.unique(codes)) < len(codes):
            raise ValueError("pieces collide")
        # one more of each, for what isn't there
        self.piece = np.array([*(entry.get(p, -1) for p in names), -1], dtype=np.int32)
        self.goes_on = np.array([*(p in goes_on for p in names), False], dtype=bool)
        # a large table of slots; entries whose slot is taken mark it as shared and go to a sorted list
        slot = self._slot(codes)
        _, first = np.unique(slot, return_index=True)
        self.key, self.value = np.zeros(1 << _SLOT_BITS, dtype=np.uint64), np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        self.key[slot[first]], self.value[slot[first]] = codes[first], first
        left = np.delete(np.arange(len(names), dtype=np.int32), first)
        left = left[np.argsort(codes[left])]
        self.shared = np.zeros(1 << _SLOT_BITS, dtype=bool)
        self.shared[slot[left]] = True
        self.other_key, self.other_value = codes[left], left

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    @staticmethod
    def _code(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) & ((1 << 64) - 1)
        return h

    def find(self, code: np.ndarray) -> np.ndarray:
        """Index of the entry with this code, or -1."""
        slot = self._slot(code)
        out = np.where(self.key[slot] == code, self.value[slot], np.int32(-1))
        at = np.flatnonzero((out < 0) & self.shared[slot])
        if len(at):
            place = np.minimum(np.searchsorted(self.other_key, code[at]), len(self.other_key) - 1)
            out[at] = np.where(self.other_key[place] == code[at], self.other_value[place], -1)
        return out

    def edges(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For n = 1, 2, ... bytes: (places, pieces) where a piece of n bytes stands.  words: (bytes, words)
        of equal length; a place is byte times words plus word, ascending."""
        length, count = words.shape
        flat = words.ravel()
        out = [(np.arange(len(flat)), self.single[flat])]  # every byte is a piece
        if length < 2:
            return out
        pair = (flat[:-count].astype(np.int64) << 8) | flat[count:]
        piece = self.pair[pair]
        at = np.flatnonzero(piece >= 0)
        out.append((at, piece[at]))
        alive = np.flatnonzero(self.pair_goes_on[pair])
        value = flat.astype(np.uint64) + np.uint64(1)
        code = value[alive] * _BASE + value[alive + count]
        for n in range(3, min(length, self.longest) + 1):
            inside = int(np.searchsorted(alive, (length - n + 1) * count))
            alive, code = alive[:inside], code[:inside]
            if len(alive) == 0:
                break
            code = code * _BASE + value[alive + (n - 1) * count]
            found = self.find(code)
            piece = self.piece[found]
            at = np.flatnonzero(piece >= 0)
            out.append((alive[at], piece[at]))
            on = np.flatnonzero(self.goes_on[found])
            alive, code = alive[on], code[on]
        return out

    def _recursion(self, words: np.ndarray, edges: list, backward: bool) -> np.ndarray:
        """log probability of the first e bytes (backward: of all from byte e on), (bytes + 1, words).

        The last places are kept as plain probabilities, rescaled every eighth byte."""
        length, count = words.shape
        cuts = [np.searchsorted(places, np.arange(length + 1) * count) for places, _ in edges]
        now, out, scale = np.zeros((length + 1, count)), np.zeros((length + 1, count)), np.zeros(count)
        now[length if backward else 0] = 1
        for step in range(1, length + 1):
            e = length - step if backward else step
            total = np.zeros(count)
            for n, ((places, pieces), cut) in enumerate(zip(edges, cuts, strict=True), start=1):
                start, other = (e, e + n) if backward else (e - n, e - n)
                if start < 0 or other > length:
                    break
                lo, hi = cut[start], cut[start + 1]
                if lo == hi:
                    continue
                if n == 1:  # of all words
                    total += now[other] * self.weight[pieces[lo:hi]]
                else:
                    at = places[lo:hi] - start * count
                    total[at] += now[other, at] * self.weight[pieces[lo:hi]]
            now[e] = total
            out[e] = np.log(total) + scale
            if step % 8 == 0:
                scale = scale + np.log(total)
                window = slice(e, e + self.longest) if backward else slice(max(0, e - self.longest + 1), e + 1)
                now[window] /= total
        return out

    def _long(self, edges: list, length: int, backward: bool) -> np.ndarray:
        """``_recursion`` of one word, place by place."""
        number = np.array([len(places) for places, _ in edges])
        places = np.concatenate([places for places, _ in edges])
        size = np.repeat(np.arange(1, len(edges) + 1), number)
        weight = np.concatenate([self.weight[pieces] for _, pieces in edges])
        key = places if backward else places + size  # the place that an edge adds to
        order = np.argsort(key, kind="stable")
        first = np.searchsorted(key[order], np.arange(length + 2)).tolist()
        size, weight = size[order].tolist(), weight[order].tolist()
        sign = 1 if backward else -1
        now, scales, scale = [0.0] * (length + 1), np.zeros(length + 1), 0.0
        now[length if backward else 0] = 1.0
        raw = [1.0] * (length + 1)
        for step in range(1, length + 1):
            e = length - step if backward else step
            total = 0.0
            for i in range(first[e], first[e + 1]):
                total += now[e + sign * size[i]] * weight[i]
            now[e] = raw[e] = total
            scales[e] = scale
            if step % 8 == 0:
                scale += math.log(total)
                for k in range(max(0, min(e, e + sign * (self.longest - 1))), min(length, max(e, e + sign * (self.longest - 1))) + 1):
                    now[k] /= total
        return np.log(np.array(raw)) + scales

    def _both(self, words: np.ndarray, edges: list, backward: bool) -> np.ndarray:
        if len(words) > LONG:
            return self._long(edges, len(words), backward)[:, None]
        return self._recursion(words, edges, backward)

    def forward(self, words: np.ndarray) -> np.ndarray:
        """alpha[i, e]: log probability of the first e bytes of word i, over all segmentations (words of equal length)."""
        turned = np.ascontiguousarray(words.T)
        return self._both(turned, self.edges(turned), backward=False).T

    def expected(self, words: np.ndarray, times: np.ndarray, into: np.ndarray) -> None:
        """Add the expected number of uses of each piece (forward-backward) to ``into``; word i stands ``times[i]`` times."""
        words = np.ascontiguousarray(words.T)
        edges = self.edges(words)
        alpha, beta = (self._both(words, edges, backward) for backward in (False, True))
        count, whole = words.shape[1], alpha[-1] - np.log(times)
        alpha, beta = alpha.ravel(), (beta - whole).ravel()
        used = [np.exp(alpha[places] + self.log[pieces] + beta[places + n * count]) for n, (places, pieces) in enumerate(edges, start=1)]
        into += np.bincount(np.concatenate([pieces for _, pieces in edges]), np.concatenate(used), len(into))


def by_length(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of bytes with the word mark in front) for words of equal length, a bounded number at a time;
    words of ``LONG`` bytes and more one by one."""
    data, offsets = buffers(column)
    length = np.diff(offsets)
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        step = max(1, limit // int(n + 1)) if n < LONG else 1
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            out = np.full((len(part), n + 1), _SPACE, dtype=np.uint8)
            out[:, 1:] = data[offsets[part][:, None] + np.arange(n)]
            yield part, out


def _group(doc_id: Column, text: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), doc_id, text), F.lit(groups)).cast("int")


def group_words(docs: DataFrame) -> DataFrame:
    """docs: (g, train, text), dealt by g.  -> (g, code, word, n): distinct words of a group (within a
    batch of it) with the number of training tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, train = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            found: dict[int, list] = {}
            for lo, _, data, offsets in chunks(batch.column(2), 4 << 20):
                data = _LOWER[data]
                words = Words(data, offsets)
                code = words.hashes()
                row = words.of_text() + lo
                for g in np.unique(groups[row]):
                    at = np.flatnonzero(groups[row] == g)
                    unique, first, which = np.unique(code[at], return_index=True, return_inverse=True)
                    n = np.bincount(which, train[row[at]], len(unique)).astype(np.int64)
                    first = at[first]
                    raw = data.tobytes()
                    text = [raw[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)]
                    found.setdefault(int(g), []).append((unique, n, text))
            for g, parts in found.items():
                code = np.concatenate([p[0] for p in parts])
                n = np.concatenate([p[1] for p in parts])
                text = pa.array([t for p in parts for t in p[2]], pa.binary())
                unique, first, which = np.unique(code, return_index=True, return_inverse=True)
                n = np.bincount(which, n, len(unique)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unique), g, np.int32)), pa.array(unique.view(np.int64)), text.take(pa.array(first)), pa.array(n)],
                    names=["g", "code", "word", "n"],
                )

    return docs.select("g", "train", "text").mapInArrow(scan, "g int, code long, word binary, n long")


def reestimate(words: DataFrame, pieces: dict[bytes, float], rounds: int = 2) -> dict[bytes, float]:
    """EM over the distinct training words of (word, n): new weights of the pieces.

    The pieces have to spell words that were hardly seen, so a word counts once.  Only sums per
    piece come to the driver, as integers (so their order doesn't matter)."""
    unit = 1 << 20
    for _ in range(rounds):
        names = list(pieces)
        weight = np.array([pieces[p] for p in names])

        def scan(batches: Iterator[pa.RecordBatch], names: list[bytes] = names, weight: np.ndarray = weight) -> Iterator[pa.RecordBatch]:
            lattice, used = Lattice(names, weight), np.zeros(len(names), dtype=np.int64)
            for batch in batches:
                for rows, matrix in by_length(batch.column(0)):
                    part = np.zeros(len(names))
                    lattice.expected(matrix, np.ones(len(rows)), part)
                    used += np.round(part * unit).astype(np.int64)
            some = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(used[some])], names=["piece", "used"])

        sums = words.where("n > 0").select("word").mapInArrow(scan, "piece long, used long").groupBy("piece").agg(F.sum("used").alias("used"))
        used = np.zeros(len(names))
        for row in sums.toLocalIterator():
            used[row["piece"]] = row["used"] / unit
        if used.sum() == 0:
            break
        used += 0.1
        pieces = dict(zip(names, used / used.sum(), strict=True))
    return pieces


@dataclass(frozen=True)
class Totals:
    tokens: int  # N: training tokens, ends included
    distinct: int  # V: distinct ones
    ends: int  # training documents
    once: int = 0  # distinct training words with count 1
    twice: int = 0  # and 2

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def log_end(self) -> float:
        """Log probability that the text ends."""
        return math.log((self.ends + 1) / (self.tokens + 2))

    def log_word(self, count: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Log probability of words of these training counts, as pieces of their own or ``spelled`` by the vocabulary's."""
        words, distinct = self.tokens - self.ends, self.distinct - (self.ends > 0)
        going_on = math.log1p(-(self.ends + 1) / (self.tokens + 2))
        if not words:
            return spelled + going_on
        # the discount of absolute discounting, by the numbers of rare words
        discount = min(max(self.once / (self.once + 2 * self.twice), 0.1), 0.9) if self.once else 0.5
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(count - discount, 0) / words)
        return np.logaddexp(whole, math.log(discount * distinct / words) + spelled) + going_on


def pack_known(known: DataFrame) -> DataFrame:
    """(g, code, n, lattice) -> (g, codes, counts, scores): one row per group and batch, values packed as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, code, n, lattice = (c.to_numpy() for c in batch.columns)
            order = np.argsort(group, kind="stable")
            groups, first = np.unique(group[order], return_index=True)
            columns = [[part.tobytes() for part in np.split(x[order], first[1:])] for x in (code, n, lattice)]
            yield pa.RecordBatch.from_arrays([pa.array(groups), *(pa.array(c, pa.binary()) for c in columns)], names=["g", "codes", "counts", "scores"])

    return known.select("g", "code", "n", "lattice").mapInArrow(run, "g int, codes binary, counts binary, scores binary")


def score_groups(stream: DataFrame, totals: Totals) -> DataFrame:
    """stream: rows of a group in order, its packed words first (is_doc false), then its documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, codes, counts, lattice = None, [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            group, is_doc = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((group[1:] != group[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(group)], strict=True):
                if lo == hi:
                    continue
                if group[lo] != at:
                    at, known = group[lo], []
                    codes, counts, lattice = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
                part = batch.slice(lo, hi - lo)
                if not is_doc[lo]:
                    known.append([b"".join(part.column(c).to_pylist()) for c in (2, 3, 4)])
                    continue
                if known:
                    joined = [b"".join(x) for x in zip(*known, strict=True)]
                    codes, counts, lattice = (np.frombuffer(x, t) for x, t in zip(joined, ("<i8", "<i8", "<f8"), strict=True))
                    order = np.argsort(codes)
                    codes, counts, lattice, known = codes[order], counts[order], lattice[order], []
                columns: list[list] = [[], [], [], []]
                for _, _, data, offsets in chunks(part.column(7)):
                    words = Words(_LOWER[data], offsets)
                    place = np.searchsorted(codes, words.hashes().view(np.int64))  # every word of the group is there
                    c = counts[place]
                    own, texts, size = words.of_text(), len(offsets) - 1, words.count()
                    columns[0].append(size + 1)
                    columns[1].append(np.bincount(own, c > 0, texts).astype(np.int64) + (totals.ends > 0))
                    columns[2].append(np.bincount(own, totals.base(c), texts) + totals.base(np.array([totals.ends])))
                    columns[3].append((np.bincount(own, lattice[place], texts) + totals.log_end()) / math.log(10))
                done = [np.concatenate(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [part.column(5), part.column(6), pa.array(done[0]), pa.array(done[1]), pa.array(np.full(hi - lo, totals.tokens, np.int64)), pa.array(done[2]), pa.array(done[3])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return stream.select("g", "is_doc", "codes", "counts", "scores", "doc_id", "held_out", "text").mapInArrow(
        scan, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def lattice_scores(words: DataFrame, pieces: dict[bytes, float], totals: Totals) -> DataFrame:
    """(word, n) -> (word, n, lattice): natural log of the word's probability over all its segmentations."""
    names = list(pieces)
    weight = np.array([pieces[p] for p in names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(names, weight)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for rows, matrix in by_length(batch.column(0)):
                out[rows] = lattice.forward(matrix)[:, -1]
            out = totals.log_word(batch.column(1).to_numpy(), out)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["word", "n", "lattice"])

    return words.select("word", "n").mapInArrow(scan, "word binary, n long, lattice double")


def score(docs: DataFrame, held_out: Column, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
          group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = rows.agg(
        F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count(F.when(~F.col("held_out"), 1)).alias("ends")
    ).first()
    size_bytes = size["bytes"] or 0
    # bounded groups, and enough of them for all tasks unless they'd be tiny
    groups = max(1, -(-size_bytes // group_bytes), min(shuffle_partitions(spark), size_bytes // LEAST_GROUP_BYTES))
    rows = rows.withColumn("g", _group(F.col("doc_id"), F.col("text"), groups))

    dealt = rows.select("g", (~F.col("held_out")).alias("train"), "text").repartitionById(groups, "g")  # a task a group
    own = materialize(group_words(dealt), "lm-group-words")
    words = materialize(own.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    n = F.col("n")
    counted = words.agg(
        F.sum("n").alias("tokens"), F.count_if(n > 0).alias("distinct"), F.count_if(n == 1).alias("once"), F.count_if(n == 2).alias("twice")
    ).first()
    ends = size["ends"]
    totals = Totals((counted["tokens"] or 0) + ends, counted["distinct"] + (ends > 0), ends, counted["once"], counted["twice"])

    pieces = reestimate(words, with_bytes(read_pieces(vocabulary)))
    scored = lattice_scores(words, pieces, totals)
    # a word that two batches of a group gave is there twice, with the same values
    known = pack_known(own.select("g", "code", "word").join(scored, "word"))
    none = F.lit(None)
    stream = (
        known.select(
            "g", F.lit(False).alias("is_doc"), "codes", "counts", "scores",
            none.cast("long").alias("doc_id"), none.cast("boolean").alias("held_out"), none.cast("string").alias("text"),
        )
        .unionByName(rows.select(
            "g", F.lit(True).alias("is_doc"), *[none.cast("binary").alias(c) for c in ("codes", "counts", "scores")], "doc_id", "held_out", "text"
        ))
        .repartitionById(groups, "g")
        .sortWithinPartitions("g", "is_doc")
    )
    return score_groups(stream, totals)
