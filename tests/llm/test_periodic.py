"""Periodic runs against a search over all periods, and the whole query against plain Python."""

import random
import zlib

import numpy as np
import odd
import pytest
from odd import docs, no_docs  # noqa: F401 (fixtures)

from loadcast.llm import periodic
from loadcast.llm.queries import op12_periodic_runs


def runs_by_hand(w: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                # a stretch with a smaller period is that one's run
                smaller = any(all(w[k] == w[k + r] for k in range(i, i + length - r)) for r in range(1, q))
                if not smaller:
                    found[i, q] = length
            i = max(j, i + 1)
    return [(i, found[i, q], q) for i, q in sorted(found)]


def in_chunk(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """The runs found when all texts are looked at together."""
    values, sizes = [], []
    for k, t in enumerate(texts):
        values += [*t, 10**9 + k]
        sizes.append(len(t) + 1)
    rows = periodic.find_runs(np.array(values, dtype=np.uint64), np.array(sizes))
    starts = np.cumsum([0, *sizes])
    out = [[] for _ in texts]
    for s, n, q in rows.tolist():
        k = int(np.searchsorted(starts, s, side="right")) - 1
        out[k].append((s - int(starts[k]), n, q))
    return out


def planted(rnd: random.Random, n: int, letters: int) -> list[int]:
    """Random words with a few stretches that repeat, some of them inside one another."""
    w = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        a = rnd.randrange(n)
        p = rnd.randint(1, max(1, (n - a) // rnd.randint(2, 6)))
        b = rnd.randint(a, n)
        for i in range(a, b):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("direct", [2, 4, 8])
@pytest.mark.parametrize("letters", [1, 2, 3, 1000])
def test_runs_equal_a_search_over_all_periods(monkeypatch, direct, letters):
    monkeypatch.setattr(periodic, "DIRECT", direct)
    rnd = random.Random(100 * direct + letters)
    for _ in range(6):
        texts = [planted(rnd, rnd.randint(1, 260), letters) for _ in range(12)] + [[]]
        assert in_chunk(texts) == [runs_by_hand(t) for t in texts]


def test_words_that_differ_in_structure():
    """Fibonacci words (runs at many scales), nested repeats, and a period cut at either end."""
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    block = [*range(40)]
    nested = ([1, 2] * 9 + [3]) * 7
    texts = [b, nested, [*range(100, 130), *(block * 5)[7:], *range(200, 230)], block * 4, (block * 4)[:-1], [5] * 6, [5] * 5]
    assert in_chunk(texts) == [runs_by_hand(t) for t in texts]
    assert in_chunk([block * 4]) == [[(0, 160, 40)]]
    assert in_chunk([(block * 4)[:-1]]) == [[]]


def test_minimisers_are_the_least_of_some_window():
    rnd = np.random.default_rng(3)
    for n in (1, 5, 40, 333):
        for width in (2, 4, 8, 32):
            v = rnd.integers(0, 50, n).astype(np.uint64)
            want = {i for lo in range(n - width + 1) for i in range(lo, lo + width) if v[i] == v[lo : lo + width].min()}
            assert set(periodic.minimisers(v, width).tolist()) == want


def collapsed_by_hand(w: list) -> list:
    gone = {i for s, n, q in runs_by_hand(w) for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def expected(doc_id, text):
    w = odd.words(text)
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_by_hand(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, runs and 1000 * best[1] // best[2] or None,
            odd.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), odd.sha(" ".join(collapsed_by_hand(w))))


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op12_on_odd_rows(spark, docs, tmp_path):  # noqa: F811
    """With ids whose texts are made to repeat (0 in the crc's last digit) and texts that repeat by themselves."""
    short = [r for r in odd.odd_rows() if r[1] is None or len(r[1]) < 5000]
    made = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 10 == 0]
    extra = [(i, odd.prose(20 + 13 * k, 3), "en", "a", 1, *odd.EXTRA) for k, i in enumerate(made)]
    extra += [(1, "ha " * 40 + "\n\t ho", "en", "a", 1, *odd.EXTRA), (3, "eins zwei " * 5 + "drei", "de", "a", 1, *odd.EXTRA)]
    spark.createDataFrame(short + extra, odd.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_periodic_runs(spark, str(tmp_path)).collect()
    want = [expected(r[0], r[1]) for r in short + extra]
    assert sorted(repr(tuple(r[c] for c in NAMES)) for r in got) == sorted(map(repr, want))
    assert any(w[1] for w in want)


def test_op12_on_an_empty_table(spark, no_docs, tmp_path):  # noqa: F811
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_periodic_runs(spark, str(tmp_path)).collect() == []


def test_a_long_text_of_one_word_and_one_without_repeats():
    n = 300_000
    same = np.full(n + 1, 7, dtype=np.uint64)
    same[-1] = 8
    assert periodic.find_runs(same, np.array([n + 1])).tolist() == [[0, n, 1]]
    other = np.random.default_rng(1).integers(0, 1 << 62, n + 1).astype(np.uint64)
    assert len(periodic.find_runs(other, np.array([n + 1]))) == 0
    half = np.concatenate([other[: n // 8]] * 5)
    assert periodic.find_runs(np.append(half, np.uint64(9)), np.array([len(half) + 1])).tolist() == [[0, len(half), n // 8]]
