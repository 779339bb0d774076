"""The registered query of each corpus operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from authlytics.llm import (
    bpe,
    centroids,
    chat,
    decontaminate,
    exact_dedup,
    language,
    near_dedup,
    oracle,
    prefix_counts,
    prefix_trie,
    simhash,
    suffix_dedup,
    urls,
    warc,
)
from authlytics.llm.byte_pairs import read_vocabulary
from authlytics.llm.common import Work, table
from authlytics.plans.storage import WorkingTables

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Work(spark)
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# The rules that go before any reputation.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the label of the document with its number: bad if of low quality
    or toxic."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"),
    )
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, outcomes, URL_RULES, WorkingTables(spark))


# A conversation whose texts look like the template.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = spark.range(2).select(
        F.lit(TRICKY_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_TEXT).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_chats(rows.unionByName(tricky))
    back = formatted.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.lit("\n")
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_prefix_counts(
    spark: SparkSession,
    sf_dir: str,
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.json"),
    limit: int = 512,
) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = prefix_counts.prefix_counts(docs, read_vocabulary(vocabulary), limit)
    over = (F.col("n_tokens") > limit).alias("over_limit")
    return counts.select("doc_id", "n_bytes", "n_tokens", over, "chars_within")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), Work(spark))
    return decided.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(
        table(spark, sf_dir, "documents"), Work(spark), keep_first=False
    )
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_bpe(
    spark: SparkSession,
    sf_dir: str,
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.json"),
) -> DataFrame:
    vocabulary = read_vocabulary(vocabulary)
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, vocabulary, Work(spark), decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "language.*")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), Work(spark))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_dedup(table(spark, sf_dir, "documents"), Work(spark), words=2)
    return found.drop("node", "key")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), Work(spark))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), Work(spark))
    return found.withColumn(
        "centroid_sha256", centroids.digest(F.col("centroid"))
    ).drop("centroid")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash(table(spark, sf_dir, "documents"), Work(spark))
    digits = F.lower(F.lpad(F.hex("value"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_urls": op2_urls,
        "op3_chat": op3_chat,
        "op4_prefix_counts": op4_prefix_counts,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_bpe": op7_bpe,
        "op8_language": op8_language,
        "op9_warc": op9_warc,
        "op10_near_dedup": op10_near_dedup,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_centroids": op12_centroids,
        "op13_simhash": op13_simhash,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracle.STATEMENTS.items() if name in queries()}
