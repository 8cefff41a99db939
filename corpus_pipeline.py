"""Training-corpus pipeline: quality, near copies, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs; all but the last return the columns
of documents. SQL can't express the learned first stage, so ORACLE_SQL is None and
the tests hold run() against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import attention_quality, byte_bpe, parity_join, qgram_decontam, secret_scan
from flowloom.llm.common import fresh, read_table
from flowloom.session import remove, shared_folder, ship

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier scores at 0.5 or more. It is fitted on the labels outside the held-out fold, over docs."""
    ship(spark)
    model = attention_quality.quality_model(docs, read_table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return attention_quality.score(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that shares 0.8 or more of five-word shingles, the document of least doc_id."""
    ship(spark)
    return parity_join.one_of_each(docs, parity_join.JaccardJoin())


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without regions of benchmark items."""
    items = read_table(ship(spark), sf_dir, "benchmark").select(F.col("item_id").cast("long"), "text")
    return qgram_decontam.without_leaks(docs, items)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text replaced by a mark and n_chars counted anew."""
    ship(spark)
    return secret_scan.redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text, how many they are, and the digests of the ids and of the bytes that they decode to."""
    ship(spark)
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), decoded=True)
    return byte_bpe.digests(encoded)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared checkpoint folder and read again; what a stage wrote goes when the next has read it."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
