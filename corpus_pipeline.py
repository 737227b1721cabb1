"""From raw documents to a tokenised training mix.

Stages, in order: quality rules (rejected documents go), n-gram Jaccard join
(one document of each group of near duplicates stays), personal data (masked
in the text), mixing of sources to target weights (documents are repeated or
left out), byte-level BPE encoding and decoding.  Each works on all that the one
before it kept and returns the columns of ``documents``; the last returns doc_id,
lang, source, n_tokens, ids and the digest of the text that the ids decode to.

SQL can't express the fitted votes, MinHash, sampling or BPE, so there is no
ORACLE_SQL; tests/llm compare a run with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import bpe, mixing, near, pii, quality
from loadcast.llm.common import documents, materialize
from loadcast.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def bpe_encoding_and_decoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    wanted = docs.select("doc_id", "lang", "source", "text")
    encoded = bpe.encode(wanted, tokenizer_file("byte_bpe_50k.json"), text="text", ids="ids", decoded_sha256="decoded_sha256")
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("personal data", personal_data),
    ("mixing sources to target weights", source_mixing),
    ("BPE encoding and decoding", bpe_encoding_and_decoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{i}")
    return docs
