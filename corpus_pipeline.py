"""A corpus through five stages, each one of the operators of ``ledgerlens.llm``: quality rules, near-duplicates,
benchmark passages, secrets, token ids. Every stage works on all its predecessor kept and its decisions take effect:
rejected documents go, one document of each group of near-duplicates stays, contaminated documents go, live secrets
are masked in the text. The last stage returns token ids instead of texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, near_duplicates, pieces, quality_rules, secret_scan
from ledgerlens.llm.arrow import small_batches
from ledgerlens.session import configure, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.without_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.without_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_outputs=False)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicate),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("sentencepiece", tokens),
]

ORACLE_SQL = None  # SQL can express neither the repeats, the signatures nor the token ids


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
