"""What Python workers hold: rows go on in small batches, and freed memory goes back to the system."""

import os

import numpy as np
import odd
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from loadcast.llm import bpe, near, quality
from loadcast.llm.queries import tokenizer_file

FIELDS = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]


class Table:
    """A frame of these fields whose mapInArrow gives the function that tasks would run."""

    columns, schema = ["doc_id", "text"], T.StructType(FIELDS)

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def a_batch(rows: int, words: int) -> pa.RecordBatch:
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, words)) for _ in range(rows)]
    return pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64()), pa.array([*texts[:-2], None, ""], pa.string())], names=Table.columns)


def passes():
    return {
        "bpe": bpe.encode(Table(), tokenizer_file("byte_bpe_50k.json"), decoded_sha256="decoded"),
        "quality": quality.with_stats(Table()),
    }


@pytest.mark.parametrize("name", ["bpe", "quality"])
def test_rows_go_on_before_the_batch_ends(name):
    batch = a_batch(6000, 200)
    out = list(passes()[name](iter([batch, batch.slice(0, 0)])))
    assert len(out) > 3 and max(b.num_rows for b in out) < 2000
    table = pa.Table.from_batches(out)
    assert table.select(Table.columns).equals(pa.Table.from_batches([batch]))
    for r in table.to_pylist()[::500]:
        if name == "bpe":
            assert r["decoded"] == odd.sha(r["text"] or "")
        else:
            assert [r["_stats"][c] for c in ("n_words", "n_repeat_words")] == [(s := odd.quality_stats(r["text"]))[0], s[4]]


def resident() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


@pytest.mark.parametrize("name", ["bpe", "quality", "near"])
def test_what_a_pass_freed_goes_back_to_the_system(name):
    found = passes() | {"near": near._sets(Table(), 5)}
    batch = a_batch(50, 50)
    freed = [bytes(900) for _ in range(200_000)]
    last = bytes(900)  # else malloc would give the end back by itself
    del freed
    before = resident()
    run = found[name](iter([batch.select(["text"]) if name == "near" else batch]))
    assert sum(b.num_rows for b in run) >= 49
    assert last and resident() < before - 100
