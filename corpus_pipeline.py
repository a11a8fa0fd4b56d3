"""Corpus pipeline: stages over ``documents``, each stored and read back before the next.

1. toxicity: documents that the trained model rejects go.
2. near_dedup: one document of each near-duplicate group stays (5-word shingles, similarity 0.8).
3. decontaminate: documents that hold a benchmark item go.
4. secrets: spans of secrets are replaced by a mark; documents stay.
5. bpe: ids of every text that is left (packed binary); the digest of the decoded text.

Null texts score 0, are linked with nothing and hold no item or secret: they stay, as empty.
Rows with a null id stay too. Rows that repeat an id are one document and stay or go together.

ORACLE_SQL is None: the stages are trained, iterative or tokenizing, which SQL cannot express;
tests/llm holds the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import bpe, decontaminate, near_dedup, secrets, toxicity
from shelfspark.llm.common import read, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped = near_dedup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(stored(dropped, "duplicates"), "doc_id", "left_anti")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(stored(leaks, "leaks"), "doc_id", "left_anti")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, bpe.production_vocabulary()).select(
        "doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secrets_stage), ("bpe", bpe_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
