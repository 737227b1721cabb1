"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can
never be merged over, so it marks a certain cut.  Texts are cut there,
fragments are encoded independently, each distinct one once per task and
batch window, and the ids are concatenated.

A cut must also leave the tokenizer's own pre-splitting as it is.  That is so
between two characters unless the left one is white space (the rule for white
space looks at what follows) or the right one is an apostrophe (which could
begin a contraction); those places, and places inside a character, aren't cut.
Strings of special tokens are taken out first, as the library does.

Decoding goes from ids to bytes by the vocabulary's own table.

Defined results: a null text is empty; an empty text has no ids and decodes to
an empty text; repeated rows are encoded row by row; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import buffers, releasing

#: Distinct fragments that a task remembers before it starts anew (bounds its memory, not the result).
REMEMBERED = 200_000
_WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"


def byte_characters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable Latin-1
    characters stand for themselves, the others get the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class FragmentTokenizer:
    """A tokenizers file, its certain cuts, and its table of token bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True  # they are taken out beforehand
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_byte = byte_characters()
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            self.token_bytes[i] = bytes(as_byte[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.cut = self._certain_cuts(spec["model"]["vocab"], as_byte)
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def _certain_cuts(vocab: dict[str, int], as_byte: dict[str, int]) -> np.ndarray:
        """cut[left, right]: a text may be cut between these two bytes."""
        cut = np.ones((256, 256), dtype=bool)
        for token in vocab:
            b = [as_byte[c] for c in token]
            cut[b[:-1], b[1:]] = False
        cut[:, 0x80:0xC0] = False  # inside a character
        cut[:, ord("'")] = False
        # after white space; by its last byte, which other characters share
        cut[[c.encode()[-1] for c in _WHITE], :] = False
        return cut.reshape(-1)

    def fragments(self, data: np.ndarray) -> list[bytes]:
        raw = data.tobytes()
        if len(data) < 2:
            return [raw] if raw else []
        at = np.flatnonzero(self.cut[data[:-1].astype(np.intp) * 256 + data[1:]]) + 1
        bounds = [0, *at.tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _learn(self, fragments: set[bytes]) -> None:
        new = list(fragments)
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            encoded = self.library.encode_batch_fast([f.decode("utf-8", "replace") for f in part], add_special_tokens=False)
            for f, e in zip(part, encoded, strict=True):
                self.known[f] = np.array(e.ids, dtype="<u4").tobytes()

    def encode_bytes(self, texts: list[np.ndarray]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self._parts(t) for t in texts]
        wanted = {f for parts in cut for part in parts if isinstance(part, list) for f in part}
        self._learn(wanted.difference(self.known))
        known = self.known.__getitem__
        return [b"".join(b"".join(map(known, p)) if isinstance(p, list) else p for p in parts) for parts in cut]

    def _parts(self, data: np.ndarray) -> list[list[bytes] | bytes]:
        """Fragment lists, and the ids of special tokens between them."""
        raw = data.tobytes()
        found = [(token.encode(), i) for token, i in self.special.items() if token.encode() in raw]
        if not found:
            return [self.fragments(data)]
        out: list[list[bytes] | bytes] = []
        at = 0
        while at < len(raw):
            nexts = [(raw.find(token, at), -len(token), token, i) for token, i in found]
            nexts = [x for x in nexts if x[0] >= 0]
            start, _, token, i = min(nexts) if nexts else (len(raw), 0, b"", None)
            out.append(self.fragments(data[at:start]))
            if i is not None:
                out.append(np.array([i], dtype="<u4").tobytes())
            at = start + len(token)
        return out

    def decode(self, ids: bytes) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def _pieces(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, texts) of pieces of about ``limit`` bytes."""
    data, offsets = buffers(column)
    lo, out, size = 0, [], 0
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        out.append(data[a:b])
        size += b - a
        if size >= limit:
            yield lo, out
            lo, out, size = lo + len(out), [], 0
    if out:
        yield lo, out


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded_sha256: str | None = None) -> DataFrame:
    """``docs`` and a column ``ids`` (array<int>): the tokens of the whole text.

    tokenizer: path of a tokenizers file that every executor can read.
    decoded_sha256: a column of this name, if given, has the digest of the text that the ids are decoded to.
    """
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_sha256:
        added.append(T.StructField(decoded_sha256, T.StringType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = FragmentTokenizer(tokenizer)
        for batch in batches:
            for lo, texts in _pieces(batch.column(at)):  # rows go on piece by piece, so none waits for the batch
                encoded = own.encode_bytes(texts)
                ends = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
                columns = [pa.ListArray.from_arrays(pa.array(ends), values)]
                if decoded_sha256:
                    columns.append(pa.array([hashlib.sha256(own.decode(e).encode()).hexdigest() for e in encoded], pa.string()))
                rows = batch.slice(lo, len(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=[*batch.schema.names, *(f.name for f in added)])

    at = docs.columns.index(text)
    return docs.mapInArrow(releasing(run), T.StructType([*docs.schema.fields, *added]))


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``tokens`` and the text that column ``ids`` stands for (null ids: null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = FragmentTokenizer(tokenizer)
        for batch in batches:
            texts = [None if row is None else own.decode(np.array(row, dtype="<u4").tobytes()) for row in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    at = tokens.columns.index(ids)
    return tokens.mapInArrow(releasing(run), T.StructType([*tokens.schema.fields, T.StructField(text, T.StringType(), True)]))


def round_trip(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes every text, decodes the ids again, and
    keeps digests of both (ids and texts go through no shuffle and no second pass)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = FragmentTokenizer(tokenizer)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for _, piece in _pieces(batch.column(1)):
                for ids in own.encode_bytes(piece):
                    counts.append(len(ids) // 4)
                    id_digests.append(hashlib.sha256(ids).hexdigest())
                    text_digests.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    wanted = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return wanted.mapInArrow(releasing(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
