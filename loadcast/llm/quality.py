"""Quality rules combined by weak supervision.

Every rule looks at statistics of one whole text and votes +1 (good), -1 (bad)
or 0 (abstains).  How reliable each rule is gets estimated from all documents
by expectation-maximisation over the counts of the vote patterns (at most
``3 ** len(RULES)`` rows, whatever the number of documents), and the posterior
probability of "good" replaces the usual all-rules-must-pass filter.

Defined results: a null text is an empty text; an empty text has all counts 0
and every rule that needs a word abstains; repeated rows and equal ids are
scored row by row; an empty table gives an empty table with the prior model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _BYTE, Words, chunks, fresh, gram_hash, mix, per_text, range_hash, releasing

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_distinct_words", "n_letter_words"]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, dtype=bool)  # ASCII letters and the first byte of any other character
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]] = True


def _repeats(keys: np.ndarray) -> np.ndarray:
    """For each key: whether another one equals it."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    twin = np.zeros(len(keys), dtype=bool)
    twin[1:] = same
    twin[:-1] |= same
    out = np.zeros(len(keys), dtype=bool)
    out[order] = twin
    return out


def _later_copies(keys: np.ndarray) -> np.ndarray:
    """For each key: whether an earlier one equals it."""
    out = np.ones(len(keys), dtype=bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out


def text_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each text of a chunk.

    Equal words, windows and lines are found by 64-bit hashes seeded with the
    text they are in.
    """
    words = Words(data, offsets)
    texts = len(offsets) - 1
    n_words = words.count()
    begins_char = (data & 0xC0) != 0x80
    out = {
        "n_words": n_words,
        "word_chars": per_text(begins_char & ~words.space, offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_letters": per_text(_LETTER[data], offsets),
    }
    letters = np.concatenate([np.zeros(1, np.int64), np.cumsum(_LETTER[data], dtype=np.int64)])
    out["n_letter_words"] = per_text(letters[words.end] > letters[words.start], words.first)
    seed = mix(np.arange(1, texts + 1, dtype=np.uint64))
    word_hash, of_text = words.hashes(), words.of_text()

    out["n_distinct_words"] = n_words - np.bincount(of_text, _later_copies(mix(word_hash ^ seed[of_text])), texts).astype(np.int64)

    # 3-word windows that lie in one text
    grams = gram_hash(word_hash, 3)
    inside = of_text[: len(grams)] == of_text[2:] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    twice = at[_repeats(mix(grams[at] ^ seed[of_text[at]]))]
    covered = np.zeros(len(word_hash) + 3, dtype=np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + 3, -1)
    out["n_repeat_words"] = per_text(np.cumsum(covered)[: len(word_hash)] > 0, words.first)

    # lines: between \n and the ends of the text
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 10) if len(ends) else ends
    in_text = np.searchsorted(offsets, starts, side="right") - 1
    has_word = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends, in_text = starts[has_word], ends[has_word], in_text[has_word]
    line_hash = range_hash(_BYTE[data], starts, ends)
    out["n_lines"] = np.bincount(in_text, minlength=texts)
    out["n_dup_lines"] = np.bincount(in_text, _later_copies(mix(line_hash ^ seed[in_text])), texts).astype(np.int64)
    return out


def with_stats(docs: DataFrame, text: str = "text", stats: str = "_stats") -> DataFrame:
    """``docs`` and a struct column ``stats`` with the statistics of the whole text."""
    kind = T.StructType([T.StructField(c, T.LongType(), False) for c in STATS])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(at)):  # rows go on chunk by chunk, so none waits for the batch
                found = text_stats(data, offsets)
                columns = [pa.array(found[c].astype(np.int64)) for c in STATS]
                struct = pa.StructArray.from_arrays(columns, fields=[pa.field(c, pa.int64(), False) for c in STATS])
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, struct], names=[*batch.schema.names, stats])

    at = docs.columns.index(text)
    return docs.mapInArrow(releasing(scan), T.StructType([*docs.schema.fields, T.StructField(stats, kind, False)]))


@dataclass(frozen=True)
class Rule:
    """Votes by the value of ``ratio`` (a SQL expression over the statistics): good at or below
    ``good``, bad above ``bad``, no vote between; null is no vote."""

    name: str
    ratio: str
    good: float
    bad: float

    def vote(self, stats: str) -> Column:
        value = F.expr(self.ratio.replace("@", f"`{stats}`."))
        return F.when(value <= self.good, 1).when(value > self.bad, -1).otherwise(0)


#: Thresholds in the style of published web-corpus filters.  A rule about small values uses a negated ratio.
RULES = [
    Rule("too_few_words", "-@n_words", -50, -50 + 1e-9),
    Rule("word_length", "abs(@word_chars / nullif(@n_words, 0) - 6.5)", 3.5, 4.5),
    Rule("symbols", "@n_symbols / nullif(@n_words, 0)", 0.05, 0.1),
    Rule("repeated_lines", "@n_dup_lines / nullif(@n_lines, 0)", 0.1, 0.3),
    Rule("repeated_windows", "if(@n_words >= 3, @n_repeat_words / @n_words, null)", 0.2, 0.5),
    Rule("letters", "1 - @n_letters / nullif(@word_chars, 0)", 0.15, 0.3),
    Rule("wordless", "1 - @n_letter_words / nullif(@n_words, 0)", 0.1, 0.3),
    Rule("vocabulary", "if(@n_words >= 20, 1 - @n_distinct_words / @n_words, null)", 0.7, 0.9),
]


@dataclass(frozen=True)
class VoteModel:
    """prior: P(good).  miss[j]: P(rule j votes bad | good, it votes); hit[j]: the same given bad."""

    prior: float
    miss: tuple[float, ...]
    hit: tuple[float, ...]

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """What each rule's good and bad vote adds to the log-odds of good."""
        miss, hit = np.array(self.miss), np.array(self.hit)
        return np.log((1 - miss) / (1 - hit)), np.log(miss / hit)

    def log_odds(self, votes: list[Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, up, down in zip(votes, *self.weights(), strict=True):
            total = total + F.when(vote > 0, float(up)).when(vote < 0, float(down)).otherwise(0.0)
        return total


def fit_votes(patterns: dict[tuple[int, ...], int], rules: int, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over counted vote patterns (abstaining says nothing).

    Rules are assumed to be right more often than not about good documents:
    P(bad vote | good) stays at most 0.2 and below P(bad vote | bad), so the
    two classes can't change places.  Pseudo-counts keep rare votes finite.
    """
    miss, hit, prior = np.full(rules, 0.02), np.full(rules, 0.4), 0.8
    if not patterns:
        return VoteModel(prior, tuple(miss.tolist()), tuple(hit.tolist()))
    keys = sorted(patterns)
    votes = np.array(keys, dtype=float).reshape(len(keys), rules)
    weight = np.array([patterns[p] for p in keys], dtype=float)
    up, down = votes > 0, votes < 0
    for _ in range(rounds):
        score = np.log(prior / (1 - prior)) + up @ np.log((1 - miss) / (1 - hit)) + down @ np.log(miss / hit)
        good = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        prior = float(np.clip((weight @ good + 8) / (weight.sum() + 10), 0.5, 0.99))
        g, b = weight * good, weight * (1 - good)
        miss = np.clip((g @ down + 0.1) / (g @ (up | down) + 5), 1e-4, 0.2)
        hit = np.clip((b @ down + 2) / (b @ (up | down) + 5), np.maximum(1.5 * miss, 0.05), 0.99)
    return VoteModel(prior, tuple(miss.tolist()), tuple(hit.tolist()))


def fit(scored: DataFrame, stats: str = "_stats", rules: list[Rule] = RULES) -> VoteModel:
    """Estimate the rules' accuracies from the vote patterns of all rows."""
    counted = scored.select(F.array(*[r.vote(stats) for r in rules]).alias("v")).groupBy("v").count()
    return fit_votes({tuple(row["v"]): row["count"] for row in counted.collect()}, len(rules))


def posterior(model: VoteModel, stats: str = "_stats", rules: list[Rule] = RULES) -> Column:
    """Probability that the document is good."""
    return 1 / (1 + F.exp(-model.log_odds([r.vote(stats) for r in rules])))


def base_failed(stats: str = "_stats") -> Column:
    s = F.col(stats)
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def quality_filter(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all their columns) that neither fail the base rules nor have a
    posterior below ``threshold``."""
    stats = fresh(docs.columns, "_stats")
    scored = with_stats(docs, text, stats)
    model = fit(with_stats(docs.select(text), text, stats), stats)
    return scored.where(~base_failed(stats) & (posterior(model, stats) >= threshold)).drop(stats)
