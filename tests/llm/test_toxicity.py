"""The field's marginals against all taggings, its gradient, spans and the whole query on odd rows."""

import itertools
import random

import numpy as np
import odd
import pytest
from odd import docs, no_docs  # noqa: F401 (fixtures)
from pyspark.sql import functions as F

from loadcast.llm import toxicity
from loadcast.llm.common import buffers
from loadcast.llm.queries import op13_toxicity


def marginals_by_hand(emission, step, start):
    """Every tagging of one text, weighed."""
    n, total = len(emission), 0.0
    each, both = np.zeros(n), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=n):
        score = sum(e * t for e, t in zip(emission, tags, strict=True)) + start * tags[0] + sum(step[a, b] for a, b in itertools.pairwise(tags))
        weight = np.exp(score)
        total += weight
        each += weight * np.array(tags)
        for a, b in itertools.pairwise(tags):
            both[a, b] += weight
    return each / total, both / total


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_marginals_are_those_of_all_taggings(monkeypatch, stretch):
    monkeypatch.setattr(toxicity, "_STRETCH", stretch)
    rng = np.random.default_rng(stretch)
    sizes = [3, 0, 1, 9, 0, 0, 6, 2, 0]
    emission, step, start = rng.normal(0, 2, sum(sizes)), rng.normal(0, 1, (2, 2)), 0.7
    first = np.concatenate([[0], np.cumsum(sizes)])
    f, b, _ = toxicity.forward_backward(emission, first, step, start)
    p = f * b / (1 + f * b)
    for lo, hi in itertools.pairwise(first):
        if hi > lo:
            assert np.allclose(p[lo:hi], marginals_by_hand(emission[lo:hi], step, start)[0])
    assert len(toxicity.forward_backward(np.zeros(0), np.zeros(3, np.int64), step, start)[0]) == 0


def test_long_and_extreme_sequences_stay_finite():
    n = 200_001
    emission = np.where(np.arange(n) % 5000 < 2500, 500.0, -500.0)
    f, b, _ = toxicity.forward_backward(emission, np.array([0, n]), np.array([[3.0, -3.0], [-3.0, 3.0]]), -2.0)
    p = f * b / (1 + f * b)
    assert np.isfinite(p).all() and p[:2400].min() > 0.99 and p[2600:4900].max() < 0.01


def test_features_are_of_the_word_and_its_neighbours():
    """Case and punctuation at the ends don't count; a neighbour in another text doesn't either."""
    texts = ["Vile, words", "(vile) words!", "vile", "", "Éon éon ???"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    t = toxicity.tokens(data, np.cumsum([0, *[len(x.encode()) for x in texts]]))
    b = t.buckets
    assert t.first.tolist() == [0, 2, 4, 5, 5, 8]
    assert (b[:, 0] == b[:, 2]).all() and (b[:, 1] == b[:, 3]).all()
    assert (b[:-1, 0] == b[:-1, 4]).all() and b[-1, 0] != b[-1, 4]  # no word follows in the third text
    assert (b[:6, 5] == b[:6, 6]).all()
    assert [bytes(data[s:e]).decode() for s, e in zip(t.start, t.end, strict=True)] == ["Vile", "words", "vile", "words", "vile", "Éon", "éon", "???"]


BAD = ["zorgwort", "zorghaft", "blatzig", "blatzung"]


def corpus(n=240):
    rows, labels, rnd = [], [], random.Random(5)
    for i in range(n):
        words = [rnd.choice(odd.WORDS) + rnd.choice(["", "", str(rnd.randint(0, 9))]) for _ in range(30 + i % 40)]
        toxic = i % 3 == 0
        if toxic:
            for k in range(1 + i % 2):
                words[(7 * k + i) % len(words)] = BAD[(i + k) % 4].title() + "!" * (i % 2)
        rows.append((i, " ".join(words), "en", "a", 1, *odd.EXTRA))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    """The query over labelled documents and the odd ones."""
    folder = tmp_path_factory.mktemp("toxic")
    rows, labels = corpus()
    both = [*rows, *[(None if r[0] is None else r[0] + 1000, *r[1:]) for r in odd.odd_rows()]]
    spark.createDataFrame(both, odd.SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    marks = [*labels, (5, 1, None), (None, 1, 1), (10**6, 1, 1), labels[0]]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return both, labels, op13_toxicity(spark, str(folder)).collect()


def test_every_row_is_scored_and_clean_ones_left_alone(scored):
    both, labels, got = scored
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(r[0]) for r in both)
    toxic = {i for i, _, t in labels if t}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (odd.fold(r["doc_id"], 3) == 1)
        assert r["predicted"] == (r["doc_id"] in toxic), r


def test_spans_are_the_offending_words(scored):
    both, _, got = scored
    text = {r[0]: r[1] for r in both if r[0] is not None and r[0] < 1000}
    found = 0
    for r in got:
        for s in filter(None, r["spans"].split(",")):
            a, b = map(int, s.split(":"))
            assert all(w.strip("!").lower() in BAD for w in text[r["doc_id"]][a:b].split())
            found += 1
    assert found > 100


def test_spans_count_code_points():
    texts = ["ééé bad bad ñ bad", "bad"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    t = toxicity.tokens(data, np.cumsum([0, *[len(x.encode()) for x in texts]]))
    lo, hi, place = toxicity.spans_of(data, t, np.array([0.1, 0.9, 0.8, 0.2, 0.9, 0.7]))
    assert [(place[t.start[a]], place[t.end[b]]) for a, b in zip(lo, hi, strict=True)] == [(4, 11), (14, 17), (17, 20)]


def test_without_both_labels_nothing_is_toxic(spark, docs, no_docs, tmp_path):  # noqa: F811
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.train(toxicity.sample(docs, labels)) is None
    assert toxicity.train(toxicity.sample(no_docs, labels)) is None
    assert {(r["score"], r["predicted"]) for r in toxicity.predict(docs, None).select("score", "predicted").collect()} == {(0.0, 0)}
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert op13_toxicity(spark, str(tmp_path)).collect() == []


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    rows, labels = corpus(60)
    df = spark.createDataFrame(rows, odd.SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    a, b = (toxicity.sample(df.repartition(n), marks, max_docs=20) for n in (2, 5))
    assert len(a.toxic) == 20 and a.toxic.sum() == 10
    assert (a.buckets == b.buckets).all() and (a.toxic == b.toxic).all()
    assert np.allclose(sorted(set(a.weight)), [2.0, 4.0])


def test_a_text_alone_scores_as_among_others(spark):
    rows, labels = corpus(90)
    df = spark.createDataFrame(rows, odd.SCHEMA)
    model = toxicity.train(toxicity.sample(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    import pyarrow as pa

    texts = [r[1] for r in rows]
    data, offsets = buffers(pa.array(texts))
    t = toxicity.tokens(data, offsets)
    together = model.scores(model.marginals(t), t.first)
    for i in (0, 1, 50):
        alone = toxicity.tokens(*buffers(pa.array([texts[i]])))
        assert np.isclose(model.scores(model.marginals(alone), alone.first)[0], together[i])
    assert df.select(F.max("doc_id")).first()[0] == 89
