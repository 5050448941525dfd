"""A training-corpus pipeline: quality, near-duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of ``documents``; what is returned is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe, decontam, minhash, quality, secrets
from gridloom.llm._util import staged, table
from gridloom.llm.queries import tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule fails or that are more probably bad than good go."""
    return quality.keep_good_documents(docs, labels=quality.labels_of(table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate texts the document with the least id stays, once, with or without ids."""
    return minhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak an item of the benchmark go."""
    return decontam.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mark_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark, and the text's length is set anew; every document stays."""
    return secrets.redact_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids, their number, and the text they decode to."""
    done = bpe.encode_documents(docs, tokenizer_file("word_bpe_49k.json"))
    return done.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scan", mark_out_secrets),
    ("token ids", encode),
]

#: SQL cannot express the stages; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
