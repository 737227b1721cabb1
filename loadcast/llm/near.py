"""N-gram Jaccard join by MinHash banding.

Two documents are linked when the sets of their 5-word shingles have a Jaccard
similarity of at least 0.8.

1. Every whole text becomes the set of its shingle hashes (64 bits), a digest
   of that set, and one hash per band of MinHash rows.  Texts with equal sets
   are one class, so copies never meet each other again.
2. Classes are shuffled on their band hashes.  Buckets with the same members
   (bands of a pair mostly agree) are looked at once.
3. The shingle sets of the classes in a bucket are sent to it, and all its
   pairs are verified exactly.  A bucket of more than ``BLOCK`` classes is cut
   into blocks, and each pair of blocks is a task of its own.  A pair that
   shares several buckets counts in the first of them only.  Pairs are never
   rows: a task returns the number of links of each member and a spanning
   forest of them.
4. The forests are joined to connected components by alternating large-star
   and small-star rounds, each written to the shared folder.

Bands and rows are chosen for the recall wanted at the threshold itself; pairs
above it are found more surely.

Defined results: a text of one to four words has one shingle, all its words; a
null text or one without a word has none and is linked to nothing; rows with
equal ids are told apart by their text; a null id counts as largest; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, fresh, gram_hash, materialize, mix, releasing, shuffle_partitions

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 100
#: Classes in a block of a large bucket.
BLOCK = 512
_COLUMNS = 8192
#: Rows of a batch that are Python objects together, besides those of the bucket at hand.
_ROWS = 512


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band (fewest false candidates) for which a pair at the
    threshold shares a band with probability ``recall``, within ``max_hashes`` hash functions.
    Raises if that many can't give it."""
    if not 0 < threshold <= 1 or not 0 < recall < 1:
        raise ValueError("threshold in (0, 1], recall in (0, 1)")
    for rows in range(max_hashes, 0, -1):
        alike = threshold**rows  # probability that all hashes of a band agree
        if alike == 0:
            continue
        bands = math.ceil(math.log1p(-recall) / math.log1p(-alike)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError(f"{max_hashes} hashes can't find pairs at {threshold} with probability {recall}")


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a chunk."""
    words = Words(data, offsets)
    hashes = words.hashes()
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        yield np.unique(gram_hash(hashes[a:b], min(n, b - a))) if b > a else hashes[:0]


def _digest(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows = bands, rows
        self.factor = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)

    def band_hashes(self, shingle_set: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(shingle_set), 4096):
            least = np.minimum(least, ((shingle_set[i : i + 4096, None] * self.factor) >> np.uint64(32)).min(axis=0))
        out = np.arange(self.bands, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T:
            out = mix(out * np.uint64(31) + column)
        return out.view(np.int64)


def _row_key(doc_id: str, text: str):
    return F.xxhash64(F.lit(11), F.col(doc_id).cast("string"), F.col(text))


def sketches(docs: DataFrame, doc_id: str, text: str, minhash: MinHash, n: int) -> DataFrame:
    """(doc_id, row, key, bands): key is the digest of the shingle set, null if there are none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            bands: list[np.ndarray] = []
            for _, _, data, offsets in chunks(batch.column(2)):
                for s in shingles(data, offsets, n):
                    keys.append(_digest(s) if len(s) else None)
                    bands.append(minhash.band_hashes(s) if len(s) else np.zeros(0, np.int64))
            lengths = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *bands]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(lengths), values)],
                names=["doc_id", "row", "key", "bands"],
            )

    wanted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _row_key(doc_id, text).alias("row"), F.col(text).alias("text"))
    return wanted.mapInArrow(releasing(scan), "doc_id long, row long, key binary, bands array<long>")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """(key, shingles): the shingle sets themselves, as packed 64-bit numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                found = list(shingles(data, offsets, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["key", "shingles"],
                )

    return texts.mapInArrow(releasing(scan), "key binary, shingles binary")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; shingles of one set only are left out first."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = int(shared.sum())
    for lo in range(0, width, _COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + _COLUMNS])
        part = np.zeros((len(sets), min(_COLUMNS, width - lo)), dtype=np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        total += part @ part.T
    return total.astype(np.int64)


def verified_links(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix: Jaccard similarity of the pair at least ``threshold`` (compared as fractions)."""
    limit = Fraction(str(threshold))
    sizes = np.array([len(s) for s in sets])
    common = intersections(sets)
    links = common * limit.denominator >= limit.numerator * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(links, False)
    return links


def _forest(links: np.ndarray) -> list[int]:
    """For each member the least member of its connected component."""
    root = list(range(len(links)))
    for i in range(len(links)):
        if root[i] == i:
            stack = [i]
            while stack:
                for k in np.flatnonzero(links[stack.pop()]):
                    if root[k] == k and k != i and k > i:
                        root[k] = i
                        stack.append(int(k))
    return root


def verify_bucket(unit: int, first: int, second: int, rows: list[tuple], threshold: float) -> Iterator[tuple[bytes, int, bytes]]:
    """Links of each member within one bucket (or one pair of its blocks).

    rows: (key, copies, block, units, shingles); a pair that shares a smaller
    unit than this one is left to that.
    """
    rows = sorted(rows, key=lambda r: r[0])
    sets = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
    links = verified_links(sets, threshold)
    if first != second:
        block = np.array([r[2] for r in rows])
        links &= block[:, None] != block[None, :]
    earlier: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        for u in r[3]:
            if u < unit:
                earlier.setdefault(u, []).append(i)
    for members in earlier.values():
        if len(members) > 1:
            links[np.ix_(members, members)] = False
    copies = np.array([r[1] for r in rows])
    for i, root in enumerate(_forest(links)):
        count = int(copies[links[i]].sum())
        if count:
            yield rows[i][0], count, rows[root][0]


def _verify_partition(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            keys, counts, roots = zip(*found, strict=True) if found else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(roots, pa.binary())], names=["key", "links", "root"]
            )

        at, rows = None, []
        for batch in (b.slice(i, _ROWS) for b in batches for i in range(0, b.num_rows, _ROWS)):
            found: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for unit, first, second, *row in zip(*columns, strict=True):
                if (unit, first, second) != at:
                    if rows:
                        found += verify_bucket(*at, rows, threshold)
                    at, rows = (unit, first, second), []
                rows.append(tuple(row))
            if found:
                yield out(found)
        if rows:
            yield out(list(verify_bucket(*at, rows, threshold)))

    return run


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root): connected components of ``edges`` (a, b); root is the least node.

    Large-star and small-star rounds; every round's edges are written out.
    Raises if ``rounds`` don't suffice, rather than return parts of components.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "edges"), None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = materialize(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = state(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components: not settled after {rounds} rounds")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL, n: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, row, class_id, rep_id, n_links, stays): one row per document.

    rep_id: least doc_id with the same shingle set; class_id: least doc_id of
    the connected component; n_links: other documents at or above the
    threshold, copies included; stays: this row is its component's first.
    """
    spark = docs.sparkSession
    minhash = MinHash(*choose_bands(threshold, recall))
    rows = materialize(sketches(docs, doc_id, text, minhash, n), "near-rows")
    classes = rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")
    )
    classes = materialize(classes, "near-classes")
    buckets = classes.select("key", F.explode("bands").alias("unit"))
    members = buckets.groupBy("unit").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y")
    )
    # bands of the same members: one of them is enough
    units = members.where(F.col("members") > 1).groupBy("members", "x", "y").agg(F.min("unit").alias("unit")).select("unit", "members")
    kept = materialize(buckets.join(units, "unit"), "near-members")
    per_class = kept.groupBy("key").agg(F.collect_list(F.struct("unit", "members")).alias("seats"))  # at most one per band
    per_class = per_class.join(classes.select("key", "row", "copies"), "key")

    texts = docs.select(_row_key(doc_id, text).alias("row"), F.col(text).alias("text")).join(per_class.select("row"), "row", "left_semi")
    sets = _sets(texts.select("text"), n).dropDuplicates(["key"])
    seats = per_class.join(sets, "key").select(
        "key", "copies", "shingles", F.transform("seats", lambda s: s["unit"]).alias("units"), F.explode("seats").alias("seat")
    )
    blocks = F.ceil(F.col("seat.members") / block).cast("int")
    placed = seats.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "key"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    tasks = placed.select(
        F.col("seat.unit").alias("unit"), F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        "key", "copies", "block", "units", "shingles",
    )
    tasks = tasks.repartition(shuffle_partitions(spark), "unit", "first", "second").sortWithinPartitions("unit", "first", "second")
    found = materialize(tasks.mapInArrow(releasing(_verify_partition(threshold)), "key binary, links long, root binary"), "near-links")

    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    first = rows.groupBy("key").agg(F.min("doc_id").alias("rep_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"), F.count(F.lit(1)).alias("copies"))
    tagged = (
        first.where(F.col("key").isNotNull())
        .join(linked, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    of_root = tagged.groupBy("root").agg(F.min("rep_id").alias("class_id"), F.min("least").alias("chosen"))
    tagged = tagged.join(of_root, "root").select(
        "key", "class_id", "rep_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("chosen")["row"].alias("chosen")
    )
    alone = F.col("key").isNull()
    return rows.drop("bands").join(tagged, "key", "left").select(
        "doc_id",
        "row",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep_id")).alias("rep_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (alone | (F.col("row") == F.col("chosen"))).alias("stays"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all their columns) with one row of each group of near duplicates; rows without a word all stay."""
    row, alone = fresh(docs.columns, "_row"), fresh(docs.columns, "_alone")
    classes = near_classes(docs, doc_id, text, threshold)
    stay = classes.where("stays").select(F.col("row").alias(row)).distinct()
    keyed = docs.withColumn(row, _row_key(doc_id, text)).withColumn(alone, F.coalesce(~F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(True)))
    wordy = keyed.where(~F.col(alone)).join(stay, row, "left_semi").dropDuplicates([row])
    return wordy.unionByName(keyed.where(F.col(alone))).select(*docs.columns)
