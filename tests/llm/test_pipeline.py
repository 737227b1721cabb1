"""The whole pipeline against plain Python, stage by stage, and the registered queries."""

import corpus_pipeline as P
import numpy as np
import odd
from odd import docs, no_docs  # noqa: F401 (fixtures)
from pyspark.sql import functions as F

import __spark_entry__ as E
from loadcast.llm import common, mixing, queries

SF01 = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    found = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in found) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(queries.ORACLE_SQL) <= set(found) <= set(E.queries())


def test_stages_agree_with_plain_python(spark):
    from tokenizers import Tokenizer

    docs = common.documents(spark, SF01)
    library = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    frames = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        frames.append(common.materialize(stage(spark, frames[-1], SF01), f"test-stage-{i}"))
    before, quality, near, pii, mixed, encoded = frames
    assert all(f.columns == docs.columns for f in frames[:5])

    kept = {r.doc_id for r in quality.collect()}
    for r in before.collect():
        s = odd.quality_stats(r.text)
        if s[0] < 50 or 2 * s[4] > s[0]:
            assert r.doc_id not in kept

    texts = sorted((r.doc_id, r.text) for r in quality.collect())
    label, _ = odd.near_components(texts)
    assert sorted(r.doc_id for r in near.collect()) == sorted({texts[c][0] for c in label})

    unmasked = {r.doc_id: r for r in near.collect()}
    for r in pii.collect():
        assert not odd.base_spans(r.text)
        old = unmasked.pop(r.doc_id)
        assert (r.text == old.text and r.n_chars == old.n_chars) or (odd.base_spans(old.text) or "[" in r.text) and r.n_chars == len(r.text)
    assert not unmasked

    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_report(pii).collect() if r.taken}
    assert {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == taken

    text = {r.doc_id: r.text for r in mixed.collect()}
    rows = encoded.collect()
    assert len(rows) == sum(taken.values())
    for r in rows[::20]:
        assert r.ids == library.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_pipeline_on_odd_and_empty_documents(spark, docs, no_docs, scratch):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, frame in (("odd", docs), ("none", no_docs)):
        frame.select(*columns).write.parquet(f"{scratch}/{name}/documents.parquet")
        got = P.run(spark, f"{scratch}/{name}").collect()
        assert (len(got) > 0) == (name == "odd")
        assert all(np.all(np.array(r.ids) >= 0) for r in got)


def test_last_stage_decodes_what_it_encoded(spark, docs, no_docs):
    name, stage = P.STAGES[-1]
    assert name == "BPE encoding and decoding"
    wanted = docs.select("doc_id", "text", "lang", "source", "n_chars")
    got = stage(spark, wanted, SF01).select("doc_id", "decoded_sha256").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r.doc_id, odd.sha(r.text or ""))) for r in wanted.collect())
    assert stage(spark, no_docs, SF01).count() == 0
