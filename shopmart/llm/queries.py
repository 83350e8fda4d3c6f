"""The registered queries of this package: thin, over whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import (conversation_repair, decontaminate, multiset_hash, packing, perplexity,
                          phrases, pii, quality, secrets, simhash, spans, suffix_dedup, token_counts,
                          toxicity)
from shopmart.llm.common import fold_of, read


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.compare_with_next(read(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest(F.col("items")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                     "toxic", keep=fold_of("doc_id", 5) != 0)
    return found.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), span=200, with_bytes=False)


def _span_columns(kinds: tuple[str, ...]):
    return [*(spans.count_kind(F.col("found.base"), k).alias(f"n_{k}") for k in kinds),
            F.sha2(spans.as_text(F.col("found.base")), 256).alias("base_sha256"),
            spans.as_text(F.col("found.spans")).alias("spans")]


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.pii_column(F.col("text")).alias("found"))
    return found.select("doc_id", *_span_columns(pii.KINDS))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = docs.select("doc_id", secrets.secrets_column(
        F.col("text"), secrets.train(docs)).alias("found"))
    return found.select("doc_id", *_span_columns(("assign", "access", "hex")))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                    "quality", keep=fold_of("doc_id", 3) != 1)
    return found.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_running_sums(
        token_counts.length_histogram(read(spark, sf_dir, "documents")))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perplexity.judge(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *(F.col(f"measures.{m}").alias(m) for m in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "base_failed", "kept")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(read(spark, sf_dir, "documents"), min_count=100, longest=5, top=2000)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(read(spark, sf_dir, "conversations"))
    return conversation_repair.report(damaged, F.col("dropped"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_document_fingerprints, op3_benchmark_decontamination,
        op4_toxicity, op5_best_fit_packing, op6_suffix_array_dedup, op7_pii, op8_secret_scans,
        op9_quality_classifier, op10_token_counts, op11_quality_rules, op12_phrase_mining,
        op13_conversation_repair)
}
_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

# DuckDB SQL, where SQL can express an operator at all.
ORACLE_SQL: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size,
  array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
 FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
 FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
hits AS (SELECT rid, i, dw.size AS size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS u(p)
 GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR),
  ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY rid)
SELECT d.doc_id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
 CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.rid = words.rid LEFT JOIN items ON d.rid = items.rid""",
    "op12_phrase_mining": phrases.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
