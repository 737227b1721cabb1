"""The manifest against a plain-Python tree, on odd rows, several arities and block sizes."""

import random
from itertools import groupby

import odd
import pytest
from odd import docs, no_docs  # noqa: F401 (fixtures)
from pyspark.sql import functions as F

from loadcast.llm import merkle
from loadcast.llm.queries import op11_merkle_manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf_by_hand(values) -> str:
    return odd.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_by_hand(leaves: list[str], arity: int) -> tuple[str, list[list[str]]]:
    """(top, per leaf its siblings with ``None`` where its own ancestor stands, level by level)."""
    level, paths = list(leaves), [[] for _ in leaves]
    step = 1
    while len(level) > 1:
        for i, path in enumerate(paths):
            at = i // step
            group = range(at - at % arity, min(at - at % arity + arity, len(level)))
            path.append([None if k == at else level[k] for k in group])
        level = [odd.sha("".join(level[k : k + arity])) for k in range(0, len(level), arity)]
        step *= arity
    return level[0], paths


def manifest_by_hand(rows, arity):
    """rows: (run, order, leaf, tampered) -> sorted (run, order, leaf, subroot, root, proof, folded)."""
    rows = sorted(rows, key=lambda r: ((r[0] is not None, (r[0] or "").encode()), (r[1] is not None, r[1] or 0), r[2]))
    runs = [(k, list(g)) for k, g in groupby(rows, key=lambda r: r[0])]
    trees = [tree_by_hand([r[2] for r in g], arity) for _, g in runs]
    root, above = tree_by_hand([t[0] for t in trees], arity)
    out = []
    for (_, g), (top, paths), up in zip(runs, trees, above, strict=True):
        for r, path in zip(g, paths, strict=True):
            node = r[3]
            for siblings in path + up:
                node = odd.sha("".join(node if s is None else s for s in siblings))
            proof = odd.sha("".join(s for siblings in path + up for s in siblings if s is not None))
            out.append((r[0], r[1], r[2], top, root, proof, node))
    return out


def found(df):
    folded = merkle.fold(F.col("tampered"), F.col("path"))
    rows = df.select("run", "at", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), folded).collect()
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize(("arity", "span"), [(2, 4), (2, 1024), (3, 9), (5, 5)])
def test_manifest_is_the_tree(spark, monkeypatch, arity, span):
    """Runs of 1 to 70 rows and 30 runs: several passes at the small spans."""
    monkeypatch.setattr(merkle, "SPAN", span)
    rnd = random.Random(span)
    rows = [(None if r == 3 else f"r{r}", rnd.choice([None, *range(50)]), f"text {rnd.randint(0, 9)}") for r in range(30) for _ in range(rnd.choice([1, 2, 3, 8, 70]))]
    df = spark.createDataFrame(rows, "run string, at long, text string").repartition(4)
    parts = [F.col("run"), F.col("at"), F.col("text")]
    changed = merkle.leaf([*parts[:2], F.concat("text", F.lit("!"))])
    tree = merkle.manifest(df, F.col("run"), [F.col("at")], parts, [F.col("run"), F.col("at"), changed.alias("tampered")], arity)
    want = manifest_by_hand([(r, a, leaf_by_hand((r, a, t)), leaf_by_hand((r, a, t + "!"))) for r, a, t in rows], arity)
    assert found(tree) == sorted(map(repr, want))


def test_op11_on_odd_rows(spark, docs, tmp_path):  # noqa: F811
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [dict(zip(docs.columns, r, strict=True)) for r in odd.odd_rows()]
    leaves = []
    for r in rows:
        values = [r[c] for c in COLUMNS]
        other = list(values)
        if odd.fold(r["doc_id"], 7) == 0 and r["n_chars"] is not None:
            other[3] += 1
        leaves.append((r["lang"], r["doc_id"], leaf_by_hand(values), leaf_by_hand(other)))
    want = [(d, leaf, top, root, proof, folded, folded == root) for _, d, leaf, top, root, proof, folded in manifest_by_hand(leaves, 2)]
    got = op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r["verified"] for r in got} == {True, False}


def test_op11_on_an_empty_table(spark, no_docs, tmp_path):  # noqa: F811
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_merkle_manifest(spark, str(tmp_path)).collect() == []


def test_an_altered_row_or_sibling_does_not_verify(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("run"))
    tree = merkle.manifest(df, F.col("run"), [F.col("id")], [F.col("id")], [F.col("id")])
    same = tree.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"))
    other = tree.select((merkle.fold(merkle.leaf([F.col("id") + 100]), F.col("path")) == F.col("root")).alias("ok"))
    assert {r["ok"] for r in same.collect()} == {True}
    assert {r["ok"] for r in other.collect()} == {False}
    with pytest.raises(ValueError, match="two children"):
        merkle.levels_of(1)
