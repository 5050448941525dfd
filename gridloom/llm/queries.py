"""Registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import bpe, decontam, merkle, minhash, pages, ppm, quality, resampling, secrets, sharding, tokencount, topk, warc
from gridloom.llm import statements as S
from gridloom.llm._util import table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(table(spark, sf_dir, "documents"))


def op2_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op7_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op8_bpe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = quality.labels_of(table(spark, sf_dir, "labels"))
    return quality.judge_documents(table(spark, sf_dir, "documents"), labels=labels)


def op11_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_scores(table(spark, sf_dir, "embeddings"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scores, op2_secret_spans, op3_shards, op4_near_duplicates, op5_main_text, op6_token_counts, op7_archives, op8_bpe_ids,
        op9_benchmark_leaks, op10_quality, op11_top_scores, op12_manifest, op13_resampled,
    )
}

#: Statements in DuckDB SQL for what SQL can express; the others are tested against brute force.
STATEMENTS = {
    # A character of base32 is five bits, which lie in two neighbouring hexadecimal digits.
    "op7_archives": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
  m AS (SELECT h, max(page_id) AS top, sha1(h) AS hex FROM p GROUP BY h)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (((
      16 * (instr('0123456789abcdef', substr(hex, CAST(((5 * i) // 4) + 1 AS INTEGER), 1)) - 1)
      + (instr('0123456789abcdef', substr(hex, CAST(((5 * i) // 4) + 2 AS INTEGER), 1)) - 1)
    ) >> CAST(3 - ((5 * i) % 4) AS INTEGER)) & 31) AS INTEGER), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM p JOIN m ON m.h = p.h""",
    "op11_top_scores": S.TOP_SCORES,
    "op12_manifest": S.MANIFEST,
    "op13_resampled": S.RESAMPLED,
}
