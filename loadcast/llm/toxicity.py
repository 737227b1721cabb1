"""Toxic spans by a linear-chain conditional random field.

Every word of a text is tagged toxic or not.  A word's emission is the sum of
the weights of its hashed features (the word, its beginnings and end, its
neighbours), and the two tags follow each other with learned weights.
Forward-backward gives each word's marginal probability; the marginals
aggregate to a document score (largest one, and expected number of toxic
words, through a calibrated logistic), and stretches of words above one half
are the offending spans.

Labels mark documents, not words.  Words are labelled in two steps: in a
document labelled toxic, those whose forms or beginnings stand in far more toxic than
clean documents; then, once a field is trained, the likeliest word of a toxic
document in which none was labelled.  The field is trained by stochastic gradient
(AdaGrad) in numpy on a bounded sample: at most ``MAX_DOCS`` labelled
documents, half of them toxic if there are enough, of ``MAX_CHARS`` characters
together, ``MAX_TEXT`` each.  What reaches the driver are feature numbers.

The chain has two tags, so forward and backward are recursions of one ratio,
x -> (a + b x) / (c + d x); a stretch of them is a 2 x 2 matrix.  All texts of
a chunk are one sequence (a text's first step forgets what was before), cut
into stretches that are worked on side by side: exact, whatever a text's length.

Defined results: a null or empty text has no words, no spans and the lowest
score; a row labelled twice is toxic if any label says so; null labels don't
count; without both labels everything scores 0; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import _BYTE, Words, chunks, mix, per_text, range_hash

#: Bounds of the training sample: documents, characters together, characters of one document.
MAX_DOCS, MAX_CHARS, MAX_TEXT = 4000, 8_000_000, 500_000
BUCKETS = 1 << 19
#: Bytes of the beginnings and of the end that are features.
HEADS, TAIL = (3, 4, 5, 6), 4
FEATURES = len(HEADS) + 4
PREDICT_AT = 0.7
#: Marginal from which a word counts towards its document's expected number.
LEAST = 0.1
_STRETCH = 64
_EDGE = np.uint64(0x5851F42D4C957F2D)

# Letters keep their lower-case byte; other ASCII at a word's ends is left out.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_CORE = np.zeros(256, dtype=bool)
_CORE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Tokens:
    """Words of a chunk of texts: byte range of their core, first word of each text, feature buckets."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    buckets: np.ndarray  # FEATURES x words


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    words = Words(data, offsets)
    folded = _FOLD[data]
    capital = np.flatnonzero((folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (folded[1:] != 0x97) & (folded[:-1] == 0xC3)) + 1
    folded[capital] += 0x20  # capital Latin-1 letters are two bytes, C3 80..9E
    core = np.flatnonzero(_CORE[data])
    start, end = words.start.copy(), words.end.copy()
    if len(core) and len(start):
        lo, hi = np.searchsorted(core, start), np.searchsorted(core, end)
        some = hi > lo  # a word without letters and digits is taken whole
        start[some], end[some] = core[lo[some]], core[hi[some] - 1] + 1
    values = _BYTE[folded]
    form = range_hash(values, start, end)
    parts = [form]
    parts += [range_hash(values, start, np.minimum(end, start + n)) + np.uint64(n) for n in HEADS]
    parts.append(range_hash(values, np.maximum(start, end - TAIL), end) + np.uint64(99))
    n = len(form)
    before, after = np.full(n, _EDGE), np.full(n, _EDGE)
    before[1:], after[:-1] = form[:-1], form[1:]
    begins = words.first[:-1][np.diff(words.first) > 0]
    before[begins] = _EDGE
    after[begins[1:] - 1] = _EDGE
    parts += [before + np.uint64(7), after + np.uint64(8)]
    buckets = np.stack([(mix(p) >> np.uint64(45)).astype(np.int32) for p in parts]) if n else np.zeros((FEATURES, 0), np.int32)
    return Tokens(start, end, words.first, buckets)


def _chain(num0: np.ndarray, num1: np.ndarray, den0: np.ndarray, den1: np.ndarray) -> np.ndarray:
    """x[t] = (num0[t] + num1[t] x[t-1]) / (den0[t] + den1[t] x[t-1]) with x[-1] = 1, in stretches side by side."""
    n = len(num0)
    if n == 0:
        return np.zeros(0)
    rows = -(-n // _STRETCH)
    coefficients = []
    for c, pad in ((num0, 0.0), (num1, 1.0), (den0, 1.0), (den1, 0.0)):  # padded by x -> x
        coefficients.append(np.append(c, np.full(rows * _STRETCH - n, pad)).reshape(rows, _STRETCH).T.copy())
    a, b, c, d = coefficients
    # each stretch as one such step: (p + q x) / (r + s x)
    p, q, r, s = np.zeros(rows), np.ones(rows), np.ones(rows), np.zeros(rows)
    for t in range(_STRETCH):
        p, q, r, s = a[t] * r + b[t] * p, a[t] * s + b[t] * q, c[t] * r + d[t] * p, c[t] * s + d[t] * q
        scale = 1 / np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    x, begin = 1.0, np.empty(rows)
    for i, (pi, qi, ri, si) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        begin[i] = x
        x = (pi + qi * x) / (ri + si * x)
    out = np.empty((_STRETCH, rows))
    now = begin
    for t in range(_STRETCH):
        now = (a[t] * 1.0 + b[t] * now) / (c[t] + d[t] * now)
        out[t] = now
    return out.T.ravel()[:n]


def forward_backward(emission: np.ndarray, first: np.ndarray, step: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward odds, backward odds, e^emission) of "toxic" for every word of all texts.

    ``step``: weights of tag i followed by tag j (0 clean, 1 toxic); ``start``: of toxic at a text's begin.
    """
    n = len(emission)
    e = np.exp(np.clip(emission, -30, 30))
    w = np.exp(step)
    begins = first[:-1][np.diff(first) > 0]
    opening = np.zeros(n, dtype=bool)
    opening[begins] = True
    # forward: f = e (w01 + w11 f') / (w00 + w10 f'); at a text's begin f = e * exp(start)
    num0, num1 = np.where(opening, e * np.exp(start), e * w[0, 1]), np.where(opening, 0.0, e * w[1, 1])
    den0, den1 = np.where(opening, 1.0, w[0, 0]), np.where(opening, 0.0, w[1, 0])
    f = _chain(num0, num1, den0, den1)
    # backward, from the end: b = (w10 + w11 e' b') / (w00 + w01 e' b'); at a text's end b = 1
    closing = np.roll(opening, -1) if n else opening
    if n:
        closing[-1] = True
    after = np.append(e[1:], 1.0)
    num0, num1 = np.where(closing, 1.0, w[1, 0]), np.where(closing, 0.0, w[1, 1] * after)
    den0, den1 = np.where(closing, 1.0, w[0, 0]), np.where(closing, 0.0, w[0, 1] * after)
    b = _chain(num0[::-1], num1[::-1], den0[::-1], den1[::-1])[::-1]
    return f, b, e


@dataclass(frozen=True)
class ToxicityModel:
    weight: np.ndarray  # of each feature bucket, for "toxic"
    bias: float
    step: np.ndarray
    start: float
    calibration: tuple[float, float, float]  # of 1, log-odds of the largest marginal, log of the expected number

    def marginals(self, t: Tokens) -> np.ndarray:
        f, b, _ = forward_backward(self.emission(t.buckets), t.first, self.step, self.start)
        return f * b / (1 + f * b)

    def emission(self, buckets: np.ndarray) -> np.ndarray:
        total = np.full(buckets.shape[1], self.bias)
        for row in buckets:
            total += self.weight[row]
        return total

    def scores(self, marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
        c = self.calibration
        top, number = aggregates(marginal, first)
        return 1 / (1 + np.exp(-np.clip(c[0] + c[1] * top + c[2] * number, -30, 30)))


def aggregates(marginal: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: log-odds of the largest marginal, log of the expected number of toxic words.

    Words under ``LEAST`` don't count, or a long clean text would add up what is left of each.
    """
    texts = len(first) - 1
    top = np.zeros(texts)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        top[some] = np.maximum.reduceat(marginal, first[:-1][some])
    top = np.clip(top, 1e-6, 1 - 1e-6)
    total = np.concatenate([[0.0], np.cumsum(np.where(marginal >= LEAST, marginal, 0.0))])
    return np.log(top / (1 - top)), np.log(np.maximum(np.diff(total[first]), 0) + LEAST)


# ---------------------------------------------------------------- training


@dataclass
class Sample:
    """Feature numbers of the sampled documents, one after the other."""

    toxic: np.ndarray
    first: np.ndarray
    buckets: np.ndarray
    weight: np.ndarray  # how many labelled rows each stands for


def label_words(s: Sample, ratio: float = 20.0, least: int = 3) -> np.ndarray:
    """Words of toxic documents whose form or beginning stands in ``least`` of them or more, and there
    ``ratio`` times as often as in clean ones."""
    doc = np.repeat(np.arange(len(s.toxic)), np.diff(s.first))
    n_toxic, n_clean = max(1, int(s.toxic.sum())), max(1, int((~s.toxic).sum()))
    chosen = np.zeros(len(doc), dtype=bool)
    for row in s.buckets[: 1 + len(HEADS)]:
        pairs = np.unique(row.astype(np.int64) * len(s.toxic) + doc)
        bucket, bad = pairs // len(s.toxic), s.toxic[pairs % len(s.toxic)]
        dirty = np.bincount(bucket[bad], minlength=BUCKETS)
        clean = np.bincount(bucket[~bad], minlength=BUCKETS)
        telling = (dirty >= least) & ((dirty + 0.5) / n_toxic > ratio * (clean + 0.5) / n_clean)
        chosen |= telling[row]
    return chosen & s.toxic[doc]


def _fit_field(s: Sample, tags: np.ndarray, docs: np.ndarray, epochs: int, seed: int, batch: int = 64) -> ToxicityModel:
    """The field that makes ``tags`` likeliest in ``docs``, with a little decay towards zero."""
    rng = np.random.default_rng(seed)
    weight, squares = np.zeros(BUCKETS, np.float64), np.full(BUCKETS, 1e-6)
    rest, rest_squares = np.zeros(6), np.full(6, 1e-6)  # bias, start, the four steps
    rest[0] = -2.0
    for epoch in range(epochs):
        pace = 0.3 / (1 + epoch / 4)
        order = rng.permutation(docs)
        for lo in range(0, len(order), batch):
            picked = order[lo : lo + batch]
            sizes = s.first[picked + 1] - s.first[picked]
            first = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(s.first[picked] - first[:-1], sizes) + np.arange(first[-1])
            if len(at) == 0:
                continue
            buckets, tag = s.buckets[:, at], tags[at].astype(np.float64)
            model = ToxicityModel(weight, rest[0], rest[2:].reshape(2, 2), rest[1], (0, 0, 0))
            f, b, e = forward_backward(model.emission(buckets), first, model.step, model.start)
            p = f * b / (1 + f * b)
            miss = p - tag
            used, back = np.unique(buckets, return_inverse=True)
            grad = np.bincount(back.ravel(), np.tile(miss, FEATURES), len(used)) + 1e-3 * weight[used]
            squares[used] += grad * grad
            weight[used] -= pace * grad / np.sqrt(squares[used])
            small = np.zeros(6)
            small[0] = miss.sum()
            begins = first[:-1][sizes > 0]
            small[1] = miss[begins].sum()
            inner = np.ones(len(at), dtype=bool)
            inner[begins] = False
            nxt = np.flatnonzero(inner)
            prev, eb = nxt - 1, e[nxt] * b[nxt]
            w = np.exp(model.step)
            pair = np.stack([np.full(len(nxt), w[0, 0]), w[0, 1] * eb, w[1, 0] * f[prev], w[1, 1] * f[prev] * eb])
            expected = (pair / pair.sum(axis=0)).sum(axis=1)
            seen = np.bincount((2 * tag[prev] + tag[nxt]).astype(np.int64), minlength=4)
            small[2:] = expected - seen
            small += 1e-3 * rest
            rest_squares += small * small
            rest -= pace * small / np.sqrt(rest_squares)
    return ToxicityModel(weight, float(rest[0]), rest[2:].reshape(2, 2).copy(), float(rest[1]), (0.0, 0.0, 0.0))


def _of_docs(s: Sample, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first) of some documents, one after the other."""
    sizes = s.first[docs + 1] - s.first[docs]
    first = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(s.first[docs] - first[:-1], sizes) + np.arange(first[-1]), first


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's steps; each label is believed a little less than fully."""
    y = 0.005 + 0.99 * y
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-3 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        move = np.linalg.solve(hess, grad)
        beta = beta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return beta


def train(s: Sample | None, epochs: int = 8, seed: int = 1) -> ToxicityModel | None:
    """The field, and the calibration of its document scores on a fifth of the sample kept apart.  None without both labels."""
    if s is None or s.toxic.all() or not s.toxic.any():
        return None
    apart = np.arange(len(s.toxic)) % 5 == 4 if min(s.toxic.sum(), (~s.toxic).sum()) >= 20 else np.zeros(len(s.toxic), dtype=bool)
    learn = np.flatnonzero(~apart)
    tags = label_words(s)
    model = _fit_field(s, tags, learn, max(1, epochs // 2), seed)
    # a toxic document without a labelled word: its likeliest word is taken to be the cause
    tagged = per_text(tags, s.first) > 0
    bare = learn[s.toxic[learn] & ~tagged[learn] & (np.diff(s.first)[learn] > 0)]
    if len(bare):
        at, first = _of_docs(s, bare)
        marginal = model.marginals(Tokens(at, at, first, s.buckets[:, at]))
        for i in range(len(bare)):
            best = int(np.argmax(marginal[first[i] : first[i + 1]]))
            if marginal[first[i] + best] > 0.05:
                tags[at[first[i] + best]] = True
    model = _fit_field(s, tags, learn, epochs, seed)
    held = np.flatnonzero(apart) if apart.any() else learn
    at, first = _of_docs(s, held)
    top, number = aggregates(model.marginals(Tokens(at, at, first, s.buckets[:, at])), first)
    x = np.stack([np.ones(len(held)), top, number], axis=1)
    beta = _logistic(x, s.toxic[held].astype(np.float64), s.weight[held] * len(held) / s.weight[held].sum())
    return ToxicityModel(model.weight.astype(np.float32), model.bias, model.step, model.start, tuple(float(v) for v in beta))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_docs: int = MAX_DOCS) -> Sample | None:
    """Feature numbers of a bounded sample of the labelled rows of ``docs``, by hash of the row; equal rows count once."""
    rows = docs.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.xxhash64(doc_id, text).alias("h"), F.col(doc_id).alias("id"), F.length(text).alias("n"), F.col(text).alias("text")
    )
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).alias("toxic"))
    known = rows.where(F.col("n") <= MAX_TEXT).select("h", "id", "n").join(marks, "id").groupBy("h").agg(F.max("n").alias("n"), F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["k"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("k")).collect()}  # two rows at most
    chosen = None
    for toxic in (True, False):
        half = known.where(F.col("toxic") == toxic).orderBy("h").limit(max_docs // 2)
        so_far = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # of max_docs / 2 rows at most
        half = half.withColumn("sum", F.sum("n").over(so_far)).where(F.col("sum") <= MAX_CHARS // 2).select("h", "toxic")
        chosen = half if chosen is None else chosen.union(half)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for lo, hi, data, offsets in chunks(batch.column(2)):
                t = tokens(data, offsets)
                found += [np.ascontiguousarray(t.buckets[:, t.first[i] : t.first[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["h", "toxic", "buckets"])

    picked = rows.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("h", "toxic", "text")  # at most max_docs numbers are sent
    table = picked.mapInArrow(scan, "h long, toxic boolean, buckets binary").orderBy("h").toArrow()
    if table.num_rows == 0:
        return None
    toxic = np.array(table["toxic"].to_pylist(), dtype=bool)
    parts = [np.frombuffer(b.as_buffer(), np.int32).reshape(FEATURES, -1) for b in table["buckets"]]
    first = np.concatenate([[0], np.cumsum([p.shape[1] for p in parts])])
    count = {k: max(1, int((toxic == k).sum())) for k in (True, False)}
    weight = np.array([total[bool(k)] / count[bool(k)] for k in toxic])
    return Sample(toxic, first, np.concatenate(parts, axis=1), weight)


# ---------------------------------------------------------------- scoring

SPAN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False), T.StructField("p", T.DoubleType(), False)])


def spans_of(data: np.ndarray, t: Tokens, marginal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first span of each text, rows start, end, p): neighbouring words above one half, in code points of their text."""
    hit = marginal > 0.5
    opens = np.zeros(len(hit) + 1, dtype=bool)
    opens[t.first] = True  # no span goes on into the next text
    lo = np.flatnonzero(hit & ~(np.append(False, hit[:-1]) & ~opens[:-1]))
    hi = np.flatnonzero(hit & ~(np.append(hit[1:], False) & ~opens[1:]))
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return lo, hi, place


def predict(docs: DataFrame, model: ToxicityModel | None, text: str = "text") -> DataFrame:
    """``docs`` without its text, and score, predicted, spans (start, end in code points, highest marginal).

    The three names must not be columns of ``docs``."""
    at = docs.columns.index(text)
    others = [f for f in docs.schema.fields if f.name != text]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = [pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False), pa.field("p", pa.float64(), False)]
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(at)):
                score, sizes = np.zeros(hi - lo), np.zeros(hi - lo, np.int32)
                rows = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
                if model is not None:
                    t = tokens(data, offsets)
                    marginal = model.marginals(t)
                    score = model.scores(marginal, t.first)
                    begin, last, place = spans_of(data, t, marginal)
                    owner = np.searchsorted(t.first, begin, side="right") - 1
                    sizes = np.bincount(owner, minlength=hi - lo).astype(np.int32)
                    zero = place[offsets[owner]]
                    high = np.array([marginal[a : b + 1].max() for a, b in zip(begin, last, strict=True)], dtype=np.float64)
                    rows = [place[t.start[begin]] - zero, place[t.end[last]] - zero, high]
                ends = pa.array(np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)]))
                spans = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(r) for r in rows], fields=struct))
                kept = [c for i, c in enumerate(batch.slice(lo, hi - lo).columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(score), pa.array((score >= PREDICT_AT).astype(np.int32)), spans],
                    names=[*(f.name for f in others), "score", "predicted", "spans"],
                )

    added = [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", T.ArrayType(SPAN, False)),
    ]
    return docs.mapInArrow(scan, T.StructType([*others, *added]))
