"""A training corpus from ``documents`` in five stages, each a Spark job over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobnest.llm import langid, minhash, mixture, secrets, sp_dropout
from jobnest.llm.queries import PIECE_BPE, vocabulary
from jobnest.session import work_root


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language can't be told: no letter, or nothing like any learned profile."""
    return langid.identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates (five-word shingles, 0.8)."""
    return minhash.keep_one(docs, shingle=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; no document goes."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as the mix takes them: a row for each run of blocks of a document, as often as it is taken."""
    return mixture.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text: doc_id, n_tokens, ids_crc32, decoded_sha256, lossless."""
    return sp_dropout.round_trip(docs, vocabulary(PIECE_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]

#: No stage but the second can be put in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_root(spark, "pipeline", unique=True)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
