"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its subwords: byte n-grams of its
lower-cased words, with a space at either end of a word, hashed into buckets.
Embeddings and softmax are trained together by stochastic gradient descent in
numpy on a bounded, stratified sample of labelled documents (``MAX_DOCS``, the
documented bound; what reaches the driver are bucket frequencies, never
texts).  A part of the sample is kept apart to fit the temperature of the
softmax and the score under which a prediction is rejected.

Every whole text is scored: embedding times softmax is one table of a logit per
bucket and language, so scoring a text is an average of table rows.

Defined results: a null text or one without a letter is ``und`` with score 0
and rejected; so is everything if nothing is labelled; a letter without a
subword in the table (there is none: all buckets have a row) can't occur;
repeated rows are scored row by row; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks

UNKNOWN = "und"
BUCKETS = 1 << 15
SIZES = (2, 3, 4)
#: Bound of the training sample, in documents; equal numbers of each language as far as they go.
MAX_DOCS = 1600
_CHUNK = 1 << 18

# Letters keep their (lower-case) byte, every other ASCII byte is a word's end.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every subword of a chunk of texts."""
    texts = len(offsets) - 1
    folded = _FOLD[data]
    # capital Latin-1 letters are two bytes, C3 80..9E
    capital = np.flatnonzero((folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (folded[1:] != 0x97) & (folded[:-1] == 0xC3)) + 1
    folded[capital] += 0x20
    # a space before each text and after the last
    spaced = np.insert(folded, offsets, np.uint8(0x20)).astype(np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(offsets) + 1)
    blank = spaced == 0x20
    buckets, owners = [], []
    for n in SIZES:
        count = len(spaced) - n + 1
        if count <= 0:
            continue
        code = np.zeros(count, dtype=np.uint64)
        keep = ~(blank[:count] & blank[n - 1 :])  # at least a letter at one end
        for i in range(n):
            code = code * np.uint64(257) + spaced[i : count + i]
            if 0 < i < n - 1:
                keep &= ~blank[i : count + i]
        at = np.flatnonzero(keep)
        code = code[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        buckets.append((code >> np.uint64(49)).astype(np.int64))
        owners.append(owner[at])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # logit of each bucket and language
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logits, number of subwords) of each text of a chunk."""
        texts = len(offsets) - 1
        bucket, owner = subwords(data, offsets)
        n = np.bincount(owner, minlength=texts)
        total = np.stack([np.bincount(owner, self.table[bucket, j], texts) for j in range(len(self.languages))], axis=1)
        return total / np.maximum(n, 1)[:, None] + self.bias, n

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _softmax(logits / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], dim: int = 16, epochs: int = 12, rate: float = 20.0, seed: int = 1) -> LanguageModel | None:
    """samples: (language, buckets, their frequencies), at least one subword each.  None without samples."""
    languages = tuple(sorted({s[0] for s in samples}))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    soft, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    label = np.array([languages.index(s[0]) for s in samples])
    # every fifth is for calibration, if there are enough
    apart = np.arange(len(samples)) % 5 == 4 if len(samples) >= 20 * len(languages) else np.zeros(len(samples), dtype=bool)
    learn = np.flatnonzero(~apart)
    steps, step = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(learn):
            _, bucket, share = samples[i]
            pace = rate * (1 - step / steps)
            step += 1
            rows = embed[bucket]
            hidden = share @ rows
            logits = hidden @ soft + bias
            grad = np.exp(logits - logits.max())
            grad /= grad.sum()
            grad[label[i]] -= 1
            back = soft @ grad
            soft -= min(pace, 2.0) * np.outer(hidden, grad)
            bias -= 0.01 * grad
            embed[bucket] = rows - pace * share[:, None] * back
    table = embed @ soft
    held = np.flatnonzero(apart) if apart.any() else learn
    logits = np.array([samples[i][2] @ table[samples[i][1]] + bias for i in held])

    def loss(t: float) -> float:
        """Mean surprise, as if one average document more had been mistaken (a faultless sample proves no certainty)."""
        p = _softmax(logits / t)
        second = np.sort(p, axis=1)[:, -2:][:, 0]
        return -float(np.log(p[np.arange(len(held)), label[held]] + 1e-12).sum() + np.log(second + 1e-12).mean())

    temperature = min((2.0 ** (k / 4) for k in range(-16, 17)), key=loss)
    p = _softmax(logits / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == label[held]]
    reject = float(np.quantile(right, 0.01)) if len(right) else 0.0  # one right prediction in a hundred is given up
    return LanguageModel(languages, table, bias, float(temperature), reject)


def sample(docs: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = MAX_DOCS) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Bucket frequencies of at most ``max_docs`` rows of ``docs``: by hash of the row, the
    languages in turn.  Equal rows count once."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(text, lang).alias("h"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    turn = Window.partitionBy("lang").orderBy("h")
    chosen = (
        rows.groupBy("h").agg(F.first("lang").alias("lang"))
        .withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= max_docs)
        .orderBy("turn", "h")
        .limit(max_docs)
        .select("h")
    )
    picked = rows.join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # at most max_docs numbers are sent

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, share = [], []
            for lo, hi, data, offsets in chunks(batch.column(2), _CHUNK):
                bucket, owner = subwords(data, offsets)
                key, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
                for i in range(hi - lo):
                    a, b = np.searchsorted(key, [i * BUCKETS, (i + 1) * BUCKETS])
                    idx.append((key[a:b] - i * BUCKETS).astype(np.int32))
                    share.append((count[a:b] / max(1, count[a:b].sum())).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(idx, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))],
                names=["h", "lang", "idx", "share"],
            )

    found = picked.select("h", "lang", "text").mapInArrow(scan, "h long, lang string, idx array<int>, share array<float>")
    table = found.orderBy("h").toArrow()
    langs, idx, share = (table[c].combine_chunks() for c in ("lang", "idx", "share"))
    return [
        (langs[i].as_py(), idx[i].values.to_numpy().astype(np.int64), share[i].values.to_numpy().astype(np.float64))
        for i in range(len(table))
        if len(idx[i].values)
    ]


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` and lang_pred, score, accepted (not rejected), from the text alone.

    The three names must not be columns of ``docs``."""
    at = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            for _, _, data, offsets in chunks(batch.column(at), _CHUNK):
                letters = (_FOLD[data] != 0x20).cumsum()
                letters = np.concatenate([[0], letters])
                some = letters[offsets[1:]] > letters[offsets[:-1]]
                if model is None:
                    langs += [UNKNOWN] * len(some)
                    scores += [0.0] * len(some)
                    continue
                logits, _ = model.logits(data, offsets)
                p = model.probabilities(logits)
                best = p.argmax(axis=1)
                for i, ok in enumerate(some):
                    if ok and (data[offsets[i] : offsets[i + 1]].max() < 0x80 or _has_letter(data[offsets[i] : offsets[i + 1]])):
                        langs.append(model.languages[best[i]])
                        scores.append(float(min(1.0, p[i, best[i]])))
                    else:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
            accepted = [la != UNKNOWN and s >= (model.reject_below if model else 1.0) for la, s in zip(langs, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "accepted"],
            )

    from pyspark.sql import types as T

    schema = T.StructType([
        *docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType()),
    ])
    return docs.mapInArrow(scan, schema)


def _has_letter(data: np.ndarray) -> bool:
    """A text with characters beyond ASCII: whether any is a letter."""
    ascii_letters = _FOLD[data[data < 0x80]] != 0x20
    return bool(ascii_letters.any()) or any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))
