"""Documents with everything that real tables hold, and plain-Python versions of the operators."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n: int, seed: int) -> str:
    """n words, some of them new each time."""
    return " ".join(WORDS[(i * seed + i // 7) % 20] + (str(i * seed % 97) if i % 3 else "") for i in range(n))


LONG = prose(30_000, 11)
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that the operators use themselves
    "size long, copies int, row long, key string, stats string, _stats string, `_row` int, ids string, g int, rank int"
)
EXTRA = (1, 2, 3, "k", "s", "t", 4, "i", 5, 6)


def odd_rows() -> list[tuple]:
    base = prose(200, 3)
    texts = [
        (1, base, "en", "b"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),  # the same row twice
        (2, prose(120, 5), None, "a"),  # the same id, another text
        (3, base.replace("gamma", "GAMMA", 2), "de", None),
        (4, None, "en", "a"),
        (5, "", None, "b"),
        (6, " \n\t ", "fr", "c"),
        (7, "...  123 \U0001f600", "fr", "c"),
        (None, base, "en", "d"),
        (None, None, None, None),
        (8, LONG, "de", "a"),
        (9, LONG[: len(LONG) // 2] + " and then some", "de", "a"),
        (10, "mail a.b@example.com or +1 (988) 555-2485, card 4111 1111 1111 1111 at 10.0.0.255 <|endoftext|> don't", "en", "b"),
        (11, "one two", "en", "b"),
        (12, "one two", "en", "b"),
        (13, "naïve 中文 tëxt wïth 'quotes' ### $$$\n\nand lines\nand lines\n", "en", "c"),
        (14, prose(300, 7), "fr", "a"),
    ]
    return [(i, t, la, s, None if t is None else len(t), *EXTRA) for i, t, la, s in texts]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id: int | None, parts: int) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % parts


def shingle_set(text: str | None) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(texts: list[tuple[int, str | None]]) -> tuple[list[int], list[int]]:
    """(component, links) of each row; a component is its first row's place."""
    sets = [shingle_set(t) for _, t in texts]
    links, label = [0] * len(sets), list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 5 * common >= 4 * (len(a) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label, links


def without_repeats(rows: list[tuple[int | None, str | None]], window: int) -> list[tuple[int, int, str]]:
    first: dict[tuple, int] = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone: set[int] = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def quality_stats(text: str | None) -> tuple:
    t, w = text or "", words(text)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def unigram_base(rows: list[tuple[int | None, str | None]]) -> list[tuple[int, int, int, float]]:
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    tokens = [[*(t or "").encode().translate(lower).split(), None] for _, t in rows]
    count = Counter(w for (i, _), ws in zip(rows, tokens, strict=True) if fold(i, 5) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    return [
        (len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for ws in tokens
    ]
