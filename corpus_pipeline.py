"""From raw documents to token ids: the stages a training corpus goes through."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlytics.llm import bpe, decontaminate, exact_dedup, language, near_dedup
from authlytics.llm.byte_pairs import read_vocabulary
from authlytics.llm.common import Work, table


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or no language that most of their words are of."""
    return language.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without blanks, the longest stays, then the smallest doc_id."""
    return exact_dedup.keep_first(docs, Work(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, over shingles of five words and a similarity of 0.8."""
    return near_dedup.keep_one(docs, Work(spark))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), Work(spark))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document: its id, token count, and digests of its ids and of their decoding."""
    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode(docs, vocabulary, Work(spark), decoded=True).select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", drop_unidentified),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("encoding", encode_texts),
]

# Language prediction, sketches and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = Work(spark).write(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
