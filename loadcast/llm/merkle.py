"""Merkle dataset manifest by lag and lead windows.

Every document is a leaf: the hash of its columns, each as its byte count, a
colon and the value, so that no two rows write the same bytes.  Leaves of one
run (here: one language) stand in one order; on every level each ``arity``
consecutive nodes become their hash, until one node is left.

The nodes of a level are the rows whose place is a multiple of the level's
step, so a sibling is a fixed number of rows away: ``lag`` and ``lead`` with
that offset, masked by the node's slot in its group and by the run's length.
The first child's row hashes the parent.  A run is cut into blocks of a power
of the arity, so all levels of a block read one shuffle and one sort, whatever
the run's length; a block's top is a leaf of the next pass, which has
``SPAN`` times fewer rows.  A row learns its ancestors' siblings by the last
non-null entry before it: the ancestor's row is the first of its subtree.

Defined results: a null column is written ``-``; a null run is a run of its
own, before all others; rows of one order value are ordered by their digest;
rows alike in all columns are leaves of their own.  An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.operators.sequence import with_sequence

from .common import materialize

#: At most this many rows of a run are one block.
SPAN = 1024


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of the UTF-8 bytes."""
    return F.sha2(text, 256)


def leaf(columns: Sequence[Column]) -> Column:
    """Hash of a row: per column ``-`` if null, else its byte count, ``:`` and its value as text."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat(*parts))


def run_key(column: Column) -> Column:
    """A run's name as a text that is never null and sorts like the column, null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def levels_of(arity: int) -> int:
    """Levels within a block."""
    if arity < 2:
        raise ValueError("a node needs two children or more")
    levels = 1
    while arity ** (levels + 1) <= SPAN:
        levels += 1
    return levels


def _climb(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (_run, _place, _size, _node and others) with the levels of their block climbed.

    Adds _block, _path (siblings' entries, lowest level first) and, on a
    block's first row, _top (its hash; null on the others).
    """
    levels = levels_of(arity)
    span = arity**levels
    place, size = F.col("_place"), F.col("_size")
    out = nodes.withColumn("_block", F.expr(f"_place div {span}")).withColumn("_top", F.col("_node"))
    w = Window.partitionBy("_run", "_block").orderBy("_place")
    for level in range(levels):
        step = arity**level
        slot = F.expr(f"(_place div {step}) % {arity}")
        far = range(arity - 1, 0, -1)
        left = [F.when(slot >= o, F.lag("_top", o * step).over(w)) for o in far]
        right = [F.when((slot + o < arity) & (place + o * step < size), F.lead("_top", o * step).over(w)) for o in reversed(far)]
        # one node on this level: it is the run's top already
        open_ = (place % step == 0) & (size > step)
        out = out.select(
            "*",
            F.concat(*[F.coalesce(c, F.lit("")) for c in left]).alias("_left"),
            F.concat(*[F.coalesce(c, F.lit("")) for c in right]).alias("_right"),
        )
        parent = F.when(place % (step * arity) == 0, digest(F.concat("_top", "_right")))
        out = out.select(
            *[c for c in out.columns if c not in ("_top", "_left", "_right")],
            F.when(open_, parent).when(size <= step, F.col("_top")).alias("_top"),
            F.when(open_, F.struct(F.col("_left").alias("left"), F.col("_right").alias("right"))).alias(f"_entry{level}"),
        )
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entries = [f"_entry{level}" for level in range(levels)]
    out = out.select(*[c for c in out.columns if c not in entries], *[F.last(e, ignorenulls=True).over(so_far).alias(e) for e in entries])
    path = F.filter(F.array(*[F.col(e) for e in entries]), lambda e: e.isNotNull())
    return out.withColumn("_path", path).drop(*entries)


def _to_top(leaves: DataFrame, arity: int, beyond=None) -> DataFrame:
    """``leaves`` (_run, _place, _size, _node and others) with _path to the run's top and _top, that top.

    ``beyond`` may lengthen the paths where they are few: it gets the last
    pass, at most a block a run, and returns it with other _path and _top.
    """
    span = arity ** levels_of(arity)
    passes = [leaves]
    longest = leaves.agg(F.max("_size")).first()[0] or 0  # one scalar
    while longest > span:
        tops = _climb(passes[-1].select("_run", "_place", "_size", "_node"), arity).where(F.col("_place") % span == 0)
        up = tops.select(
            "_run", F.expr(f"_place div {span}").alias("_place"), F.expr(f"(_size + {span - 1}) div {span}").alias("_size"), F.col("_top").alias("_node")
        )
        passes.append(materialize(up, "merkle-tops"))
        longest = -(-longest // span)
    so_far = Window.partitionBy("_run", "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = _climb(passes[-1], arity).withColumn("_top", F.first("_top").over(so_far)).drop("_block")
    if beyond is not None:
        found = beyond(found)
    for lower in reversed(passes[:-1]):
        upper = found.select("_run", F.col("_place").alias("_block"), F.col("_path").alias("_above"), *[c for c in found.columns if c not in ("_run", "_place", "_size", "_node", "_path")])
        found = _climb(lower, arity).drop("_top").join(upper, ["_run", "_block"])
        found = found.withColumn("_path", F.concat("_path", "_above")).drop("_above", "_block")
    return found


def manifest(rows: DataFrame, run: Column, order: Sequence[Column], columns: Sequence[Column], keep: Sequence[Column], arity: int = 2) -> DataFrame:
    """Per row of ``rows``: the columns ``keep``, then leaf, path, subroot and root.

    ``run`` names the row's run, ``order`` its place there, ``columns`` are what
    the leaf hashes.  path lists, lowest level first, the siblings before
    (left) and after the row's ancestor (right), up to the root of all runs.
    Only digests, names, order and ``keep`` are written and shuffled.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    leaves = materialize(
        rows.select(F.struct(*keep).alias("_kept"), run_key(run).alias("_run"), leaf(columns).alias("_node"), *[c.alias(k) for c, k in zip(order, keys, strict=True)]),
        "merkle-leaves",
    )
    numbered = with_sequence(leaves, [*keys, "_node"], ["_run"], rn_col="_place").drop(*keys)
    sizes = leaves.groupBy("_run").agg(F.count(F.lit(1)).alias("_size"))

    def beyond(found: DataFrame) -> DataFrame:
        """The runs' tops are the leaves of one more run, ordered by name."""
        tops = materialize(found.where(F.col("_place") == 0).select(F.col("_run").alias("_of"), F.col("_top").alias("_node")), "merkle-roots")
        one = with_sequence(tops, ["_of"], rn_col="_place").withColumns({"_size": F.lit(tops.count()).cast("long"), "_run": F.lit("")})
        last = _to_top(one, arity).select(F.col("_of").alias("_run"), F.col("_path").alias("_last"), F.col("_top").alias("_root"))
        return found.join(last, "_run").withColumn("_path", F.concat("_path", "_last")).drop("_last")

    found = _to_top(numbered.join(sizes, "_run"), arity, beyond)
    return found.select("_kept.*", F.col("_node").alias("leaf"), F.col("_path").alias("path"), F.col("_top").alias("subroot"), F.col("_root").alias("root"))


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, node, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))
