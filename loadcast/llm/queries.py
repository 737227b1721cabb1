"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, langid, lm, merkle, mixing, near, periodic, pii, quality, substring, topk, toxicity
from .common import WORD, documents, fold, materialize

# Conversation -7, whose texts hold control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file; it's installed at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, folded from a streamed and corrected log, formatted and read back: digests per conversation."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(chat.turns_as_streams(turns.unionByName(extra))))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best integer inner products of every fiftieth vector with all others."""
    return topk.top_k(topk.quantized(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), k=5, every=50)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.train(langid.sample(docs.where(~held_out)))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that 50-word windows repeat from smaller documents."""
    found = substring.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-unigram base and subword-lattice score of every document."""
    return lm.score(documents(spark, sf_dir), fold(F.col("doc_id"), 5) == 1, tokenizer_file("piece_bpe_32k.model"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, component and number of near duplicates of every document."""
    return near.near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "rep_id", "n_links")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mix_report(documents(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    return bpe.round_trip(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics, and whether the weighed quality rules keep the document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = materialize(quality.with_stats(docs, stats="stats").drop("text"), "quality-stats")
    p = quality.posterior(quality.fit(scored, "stats"), "stats")
    failed = quality.base_failed("stats")
    return scored.select(
        "doc_id",
        *[F.col(f"stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & (p >= 0.5)).alias("kept"),
        p.alias("p_good"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data found in every document."""
    return pii.pii_report(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether the row (some are tampered with) still folds to the root."""
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    n_chars = F.col("n_chars") + F.when(fold(F.col("doc_id"), 7) == 0, 1).otherwise(0)
    tampered = merkle.leaf([n_chars if i == 3 else c for i, c in enumerate(parts)])
    tree = merkle.manifest(documents(spark, sf_dir), F.col("lang"), [F.col("doc_id")], parts, [F.col("doc_id"), tampered.alias("tampered")])
    folded = tree.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts of every tenth document (by the id's crc32) end in copies of some of their words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))

    def repeated(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i))), " ")).otherwise("")

    # the lambda binds the words, so that they are found once a text
    return docs.select("doc_id", F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, and digests of them and of the text without their repeats."""
    found = periodic.collapse(repeated_tails(documents(spark, sf_dir)))
    best = periodic.longest(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.sha2(periodic.listing(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("1000 * length div period"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from two thirds of the labels, and the spans that make it up."""
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 3) == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 3) != 1)
    model = toxicity.train(toxicity.sample(docs.where(~held_out), labels))
    found = toxicity.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    listed = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.withColumn("spans", F.array_join(listed, ","))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_exact_top_k, op3_language_id, op4_substring_dedup, op5_lm_scoring,
        op6_ngram_jaccard_join, op7_mixing, op8_bpe, op9_quality_rules, op10_pii, op11_merkle_manifest, op12_periodic_runs, op13_toxicity,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')
        ), e AS (
            SELECT *, regexp_replace(text, '([<\[])(\\*)({chat.REST})', '\1\\\2\3', 'g') AS safe FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
            CAST(sum(length('{chat.START}') + length(role) + 1 + length(safe) + length('{chat.END}') + 1) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS p FROM embeddings
            WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND coalesce(list_bool_and([isfinite(x) FOR x IN embedding]), true)
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.p, c.p) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op4_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), win AS (
            SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
        ), f AS (
            SELECT k, min(doc_id) AS low FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN f USING (k) WHERE doc_id > low
        ), word AS (
            SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d
        ), kept AS (
            SELECT word.doc_id, count(gone.j) AS n_removed,
                coalesce(string_agg(CASE WHEN gone.j IS NULL THEN x END, ' ' ORDER BY word.j), '') AS text
            FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.j = gone.j GROUP BY word.doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op11_merkle_manifest": r"""
        WITH RECURSIVE d AS (
            SELECT *, list_reduce(
                [CAST(4294967295 AS BIGINT)] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')],
                lambda c, b: list_reduce([xor(c, b)] || [CAST(i AS BIGINT) FOR i IN range(8)], lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END))
            ) AS inverted FROM documents
        ), p AS (
            SELECT doc_id, lang, [coalesce(strlen(x) || ':' || x, '-') FOR x IN [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text]] AS a,
                [coalesce(strlen(x) || ':' || x, '-') FOR x IN [CAST(doc_id AS VARCHAR), source, lang,
                    CAST(n_chars + CASE WHEN coalesce(xor(inverted, 4294967295), 0) % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR), text]] AS b
            FROM d
        ), leaf AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS run, sha256(array_to_string(a, '')) AS leaf, sha256(array_to_string(b, '')) AS tampered FROM p
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY run) AS n FROM leaf
        ), tree AS (
            SELECT 0 AS level, run, p, n, leaf AS node FROM placed
            UNION ALL
            SELECT level + 1, run, p // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY p)) FROM tree WHERE n > 1 GROUP BY level, run, p // 2, n
        ), sub AS (
            SELECT run, node AS subroot, row_number() OVER (ORDER BY run) - 1 AS p, count(*) OVER () AS n FROM tree WHERE n = 1
        ), top AS (
            SELECT 0 AS level, p, n, subroot AS node FROM sub
            UNION ALL
            SELECT level + 1, p // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY p)) FROM top WHERE n > 1 GROUP BY level, p // 2, n
        ), up AS (
            SELECT sub.run, list(CASE WHEN o.node IS NULL THEN '-' WHEN o.p % 2 = 0 THEN 'L' || o.node ELSE 'R' || o.node END ORDER BY m.level) AS steps
            FROM sub JOIN top m ON m.n > 1 AND m.p = sub.p >> m.level LEFT JOIN top o ON o.level = m.level AND o.p = xor(m.p, 1) GROUP BY sub.run
        ), low AS (
            SELECT w.run, w.p, list(CASE WHEN o.node IS NULL THEN '-' WHEN o.p % 2 = 0 THEN 'L' || o.node ELSE 'R' || o.node END ORDER BY m.level) AS steps
            FROM placed w JOIN tree m ON m.n > 1 AND m.run = w.run AND m.p = w.p >> m.level
            LEFT JOIN tree o ON o.run = m.run AND o.level = m.level AND o.p = xor(m.p, 1) GROUP BY w.run, w.p
        ), whole AS (
            SELECT w.*, subroot, (SELECT node FROM top WHERE n = 1) AS root, coalesce(low.steps, []) || coalesce(up.steps, []) AS steps
            FROM placed w JOIN sub ON sub.run = w.run LEFT JOIN low ON low.run = w.run AND low.p = w.p LEFT JOIN up ON up.run = w.run
        ), folded AS (
            SELECT *, list_reduce([tampered] || steps, lambda node, s: CASE
                WHEN s = '-' THEN sha256(node) WHEN s[1] = 'L' THEN sha256(s[2:] || node) ELSE sha256(node || s[2:]) END) AS folded_root FROM whole
        )
        SELECT doc_id, leaf, subroot, root, sha256(array_to_string([s[2:] FOR s IN steps], '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM folded
    """,
}
