"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

The mix has as many words as the input.  Sources, by code point with null
last, weigh 5, 2, 1, 5, 2, 1, ...; a source's target stops at ``max_copies``
times its own size and the excess is shared again by weight.  A source whose
target is ``f`` times its size gives ``floor(f)`` whole copies of every
document for certain; the rest is a sample of words of fixed size: documents
are ranked by Q = (U / (1 - U)) / (p / (1 - p)), with U a hash of the document
and p = f - floor(f) its inclusion probability, and taken from the smallest Q
on while they fit.  Where one doesn't, those behind it that aren't larger than
what is missing go on in the same way, until none that is left over fits.  Last,
the one document left over whose size is nearest to the words still missing is taken
if that brings the source nearer its target.

No source is ever in one task: Q is cut into ``BINS`` ranges whose sizes are
summed first, and only the documents of the range that the sample ends in are
put in order.  One row per source goes through a single task.

Defined results: a null text has size 0 and is taken 0 words; a null source is
a source of its own; rows equal in id, source and text share one draw (all or
none are taken); an empty table gives an empty table.  The draw depends on the
row's id and text alone, so reruns agree whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, fresh, materialize

# The repeating weights of sources in order.
WEIGHTS = (5, 2, 1)
BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(doc_id: Column, text: Column, seed: int) -> Column:
    """Uniform in (0, 1), fixed by the row."""
    h = F.xxhash64(F.lit(seed), doc_id.cast("string"), text)
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 7) -> DataFrame:
    """(doc_id, source, size, u) of every row, without the text."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        _draw(F.col(doc_id), F.col(text), seed).alias("u"),
    )


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3) -> DataFrame:
    """(source, source_size, target, certain, p): one row per source.

    With targets min(cap, c * weight), the capped sources come first by
    cap / weight; going through the sources in that order, one is capped if
    sharing what is left by weight would lift it above its cap.
    """
    everything = Window.partitionBy()
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = by_source.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)).withColumn(
        "cap", F.col("source_size") * float(max_copies)
    )
    order = everything.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    share = weighed.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest),
    ).withColumn("capped", F.col("cap") < F.col("level") * F.col("w"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(everything)["level"]
    target = F.when(F.col("capped") | (F.col("cap") == 0), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("w")))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        share.withColumn("target", target)
        .withColumn("certain", F.floor(copies))
        .withColumn("p", copies - F.floor(copies))
        .select("source", "source_size", "target", "certain", "p")
    )


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null matching null; the left side's column stays."""
    keyed = right.withColumnRenamed("source", "_source")
    return left.join(keyed, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _rank() -> Column:
    """Q, brought into (0, 1) as Q / (1 + Q); null where nothing is left to sample."""
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return F.when(F.col("p") > 0, q / (1 + q))


def _fill(ranks: DataFrame, state: DataFrame) -> DataFrame:
    """(source, hi, upto): how far a source can go on from ``state`` (source, lo, upto).

    ranks: those that may still be taken, with the words wanted; rows are
    taken by rank while they fit, the words so far added to ``upto``.
    """
    bins = (
        ranks.groupBy("source", "bin")
        .agg(F.sum("words").alias("bin_words"), F.first("want").alias("want"))
        .withColumn("sum", F.sum("bin_words").over(Window.partitionBy("source").orderBy("bin")))
    )
    # the first range that doesn't fit as a whole (or none)
    over = F.col("upto") + F.col("sum") > F.col("want")
    edge = (
        _by_source(bins, state)
        .groupBy("source", "lo", "upto")
        .agg(F.min(F.when(over, F.col("bin"))).alias("edge_bin"), F.max(F.when(~over, F.col("sum"))).alias("whole"))
        .select(
            "source", "lo", F.coalesce("edge_bin", F.lit(BINS + 1)).alias("edge_bin"),
            (F.col("upto") + F.coalesce("whole", F.lit(0))).alias("edge_before"),
        )
    )
    ordered = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.col("sum") <= F.col("want")
    cut = (
        _by_source(ranks, edge.drop("lo"))
        .where(F.col("bin") == F.col("edge_bin"))
        .withColumn("sum", F.col("edge_before") + F.sum("words").over(ordered))
        .groupBy("source")
        .agg(F.max(F.when(fits, F.col("rank"))).alias("cut_rank"), F.max(F.when(fits, F.col("sum"))).alias("cut_upto"))
    )
    return _by_source(edge, cut, "left").select(
        "source",
        F.greatest("lo", F.coalesce("cut_rank", F.col("edge_bin") / BINS * (1 - 2.0**-50))).alias("hi"),
        F.coalesce("cut_upto", "edge_before").alias("upto"),
    )


def _next_fit(ranks: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` (source, wanted, hi, upto, steps) and ``lo``, the first rank above ``hi`` whose words fit (or null)."""
    fits = (F.col("rank") > F.col("hi")) & (F.col("words") <= F.col("wanted") - F.col("upto"))
    first = _by_source(ranks, state.drop("steps")).where(fits).groupBy("source").agg(F.min("rank").alias("lo"))
    return _by_source(state, first, "left").select("source", "wanted", "hi", "upto", "steps", "lo")


def sample_plan(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` and what to sample: ``steps`` (documents of rank lo to hi, of at most ``limit``
    words), and the one of rank ``extra``."""
    drawn = (
        _by_source(rows, targets)
        .select("source", "size", "u", "p", (F.col("target") - F.col("certain") * F.col("source_size")).alias("want"))
        .withColumn("rank", _rank())
        .where(F.col("rank").isNotNull() & (F.col("size") > 0))
    )
    # rows of equal rank stand or fall together
    ranks = drawn.groupBy("source", "rank").agg(F.sum("size").alias("words"), F.max("size").alias("size"), F.first("want").alias("want"))
    binned = materialize(ranks.withColumn("bin", F.floor(F.col("rank") * BINS)), "mix-ranks")
    no_steps = F.array().cast("array<struct<lo:double,hi:double,limit:double>>")
    state = materialize(
        _next_fit(
            binned,
            binned.groupBy("source").agg(F.first("want").alias("wanted"))
            .select("source", "wanted", F.lit(-1.0).alias("hi"), F.lit(0).cast("long").alias("upto"), no_steps.alias("steps")),
        ),
        "mix-state",
    )
    # every round takes a document at least, so what is missing shrinks until none fits
    while not state.where(F.col("lo").isNotNull()).isEmpty():
        # past the document that didn't fit, those go on that aren't larger than what is missing
        gap = F.col("wanted") - F.col("upto")
        open_ranks = _by_source(binned, state.drop("steps")).where((F.col("rank") >= F.col("lo")) & (F.col("size") <= gap))
        filled = _fill(open_ranks.select(*binned.columns), state.select("source", "lo", "upto"))
        filled = filled.withColumnRenamed("hi", "new_hi").withColumnRenamed("upto", "new_upto")
        step = F.array(F.struct("lo", F.col("new_hi").alias("hi"), gap.alias("limit")))
        gone_on = materialize(
            _by_source(state, filled, "left").select(
                "source", "wanted", F.coalesce("new_hi", "hi").alias("hi"), F.coalesce("new_upto", "upto").alias("upto"),
                F.when(F.col("new_hi").isNull(), F.col("steps")).otherwise(F.concat("steps", step)).alias("steps"),
            ),
            "mix-state",
        )
        state = materialize(_next_fit(binned, gone_on), "mix-state")
    left_over = _by_source(binned, state).where(~_in_steps(F.col("rank"), F.col("size"), F.col("steps")))
    miss = F.abs(F.col("want") - F.col("upto") - F.col("words"))
    extra = (
        left_over.where(miss < F.col("want") - F.col("upto"))
        .groupBy("source")
        .agg(F.min(F.struct(miss.alias("miss"), "rank"))["rank"].alias("extra"))
    )
    return _by_source(_by_source(targets, state.select("source", "steps"), "left"), extra, "left").select(
        "source", "source_size", "target", "certain", "p", "steps", "extra"
    )


def _in_steps(rank: Column, size: Column, steps: Column) -> Column:
    return F.exists(steps, lambda s: (rank >= s["lo"]) & (rank <= s["hi"]) & (size <= s["limit"]))


def _sampled(rank: Column, size: Column, steps: Column, extra: Column) -> Column:
    return F.coalesce(_in_steps(rank, size, steps) | (rank == extra), F.lit(False))


def _copies() -> Column:
    sampled = _sampled(_rank(), F.col("size"), F.col("steps"), F.col("extra"))
    return F.when(F.col("size") > 0, F.col("certain") + sampled.cast("long")).otherwise(F.lit(0)).cast("long")


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(sized rows, plan by source), both in the shared scratch folder: the text is read once."""
    rows = materialize(sized(docs, doc_id, source, text, seed), "mix-sizes")
    targets = materialize(source_targets(rows, weights, max_copies), "mix-targets")
    return rows, materialize(sample_plan(rows, targets), "mix-plan")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    rows, plan = plan_mix(docs)
    return _by_source(rows, plan).select(
        "doc_id", "size", "source_size", "target", (_copies() * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: rows of ``docs`` with their columns, as often as they are taken."""
    _, plan = plan_mix(docs, doc_id, source, text, weights, max_copies, seed)
    # column names of our own, so that none of the input's clashes
    own = {name: fresh(docs.columns, f"_mix_{name}") for name in ("source", "size", "u", *plan.columns, "copies")}
    plan = plan.select([F.col(c).alias(own[c]) for c in plan.columns])
    drawn = docs.withColumn(own["size"], word_count(F.col(text))).withColumn(own["u"], _draw(F.col(doc_id), F.col(text), seed))
    joined = drawn.join(plan, F.col(source).cast("string").eqNullSafe(F.col(own["source"])))
    rank_q = (F.col(own["u"]) / (1 - F.col(own["u"]))) / (F.col(own["p"]) / (1 - F.col(own["p"])))
    rank = F.when(F.col(own["p"]) > 0, rank_q / (1 + rank_q))
    sampled = _sampled(rank, F.col(own["size"]), F.col(own["steps"]), F.col(own["extra"])).cast("int")
    copies = F.when(F.col(own["size"]) > 0, F.col(own["certain"]).cast("int") + sampled).otherwise(0)
    return joined.withColumn(own["copies"], F.explode(F.array_repeat(F.lit(True), copies))).select(*docs.columns)
