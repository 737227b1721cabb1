"""Exact top-k inner products by no-random-access aggregation.

Candidates are cut into blocks, queries too, and every pair of blocks is one
task.  In a block each dimension is a list of the candidates sorted by that
component.  For a query, a list is read from the end that its weight prefers;
all lists are read to the same depth, a step at a time.  After a step each
candidate has a lower and an upper bound of its score: its seen parts, plus for
each unseen part the least the list can still give, or the value at the depth
reached.  Reading stops when at least k candidates have been bounded from below
above all others' upper bounds; the scores of the candidates that still can
qualify (ties included) are then resolved.  The best k of every block are
merged by query.

The queries of a block are read together, so a step is a few matrix products.
Only a pair of blocks is ever in a task; the blocks' sizes are fixed, so their
number grows with the data.

Defined results: a vector that is null or holds a null or non-finite component
takes no part; a shorter vector counts as padded with zeros; rows are told
apart even if they are equal (a row is no candidate of its own query, its twin
is), ties go to the smaller vec_id, null ids last; no candidates, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

BLOCK = 4096
#: Depths, as parts of the lists, at which the bounds are compared.
DEPTHS = (0.25, 0.5, 0.7, 0.85, 0.95)
_EXACT = 1 << 53


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(row, vec_id, parts): integer parts floor(scale * x) of the vectors that take part, written out
    so that row numbers are the same whenever they are read."""
    x = F.col(embedding)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    return materialize(
        vectors.where(x.isNotNull() & finite).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(vec_id).cast("long").alias("vec_id"),
            F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long")).alias("parts"),
        ),
        "topk-vectors",
    )


def _matrix(parts: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(parts), width), dtype=np.int64)
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out


def block_top_k(query: np.ndarray, query_row: np.ndarray, cand: np.ndarray, cand_row: np.ndarray, cand_id: np.ndarray, k: int,
                depths: tuple[float, ...] = DEPTHS) -> tuple[list[tuple[int, int, int]], float]:
    """[(query's place, candidate's place, score)], and the part of the lists that was read on average."""
    n, width = cand.shape
    number = np.float64
    if n and width and len(query) and float(np.abs(query).max()) * float(np.abs(cand).max()) * width * 2 >= _EXACT:
        number = object  # Python integers where doubles wouldn't be exact
    cand_n, query_n = cand.astype(number), query.astype(number)
    order = np.argsort(cand, axis=0, kind="stable")  # the sorted lists, ascending
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
    ascending = np.take_along_axis(cand_n, order, axis=0)
    rising, falling = np.where(query_n > 0, query_n, 0), np.where(query_n < 0, query_n, 0)

    out: list[tuple[int, int, int]] = []
    own = {int(r): i for i, r in enumerate(cand_row)}
    mine = np.array([own.get(int(r), -1) for r in query_row])
    open_queries, read = np.arange(len(query)), 0.0
    for depth in [*depths, 1.0]:
        if not len(open_queries):
            break
        seen = max(1, int(n * depth))
        up, down = rising[open_queries], falling[open_queries]
        high, low = place >= n - seen, place < seen  # seen by queries that read from the top, from the bottom
        known = up @ np.where(high, cand_n, 0).T + down @ np.where(low, cand_n, 0).T
        if seen < n:
            # unseen parts lie between the list's far end and the value at the depth
            top, bottom = ascending[n - seen], ascending[seen - 1]
            unseen_up, unseen_down = (~high).astype(number), (~low).astype(number)
            most = known + (up * top) @ unseen_up.T + (down * bottom) @ unseen_down.T
            least = known + (up * ascending[0]) @ unseen_up.T + (down * ascending[-1]) @ unseen_down.T
        else:
            most = least = known
        done = []
        for j, q in enumerate(open_queries):
            lower, upper = least[j], most[j]
            others = np.ones(n, dtype=bool)
            if mine[q] >= 0:
                others[mine[q]] = False
            at = np.flatnonzero(others)
            if len(at) > k:
                kth = np.partition(lower[at], len(at) - k)[len(at) - k]
                at = at[upper[at] >= kth]  # nobody else can qualify
                if seen < n and len(at) > max(4 * k, n // 16):
                    continue  # too many could: read on
            score = cand_n[at] @ query_n[q]
            for i in np.lexsort((cand_id[at], -score))[:k]:
                out.append((int(q), int(at[i]), int(score[i])))
            done.append(j)
            read += depth
        open_queries = np.delete(open_queries, done)
    return out, read / max(1, len(query))


def _pair(k: int):
    schema = ["query_row", "query_id", "vec_id", "score"]

    def run(queries: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(cands):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in schema})
        width = max(max(map(len, queries["parts"])), max(map(len, cands["parts"])))
        ids = cands["vec_id"].fillna(np.iinfo(np.int64).max).astype("int64").to_numpy()
        found, _ = block_top_k(
            _matrix(queries["parts"], width), queries["row"].to_numpy(), _matrix(cands["parts"], width), cands["row"].to_numpy(), ids, k
        )
        q, c, s = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
        return pd.DataFrame({
            "query_row": queries["row"].to_numpy()[q], "query_id": queries["vec_id"].to_numpy()[q],
            "vec_id": cands["vec_id"].astype("Int64").array[c], "score": s,
        }, columns=schema)

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each row whose id is
    divisible by ``every``.  vectors: (row, vec_id, parts) as from ``quantized``."""
    is_query = F.col("vec_id") % every == 0
    counts = vectors.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    cand_blocks, query_blocks = (max(1, -(-x // block)) for x in (counts["n"], counts["q"]))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        mixed = df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        return mixed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    queries = dealt(vectors.where(is_query), "qb", query_blocks, "cb", cand_blocks)
    cands = dealt(vectors, "cb", cand_blocks, "qb", query_blocks)
    found = queries.groupBy("qb", "cb").cogroup(cands.groupBy("qb", "cb")).applyInPandas(
        _pair(k), "query_row long, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
