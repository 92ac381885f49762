"""Queries over the document tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import conversations, exact_dedup, fingerprints, jaccard_join, lm_score, mixing, packing, pieces, secrets, spelling, sql, substring_dedup, suffix_dedup, toxicity
from ledgerline.registry.common import Entry


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


def op1_source_mix(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mixed(documents(spark, directory)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.round("position", 9).alias("position"),
    )


def op2_ngram_jaccard(spark: SparkSession, directory: str) -> DataFrame:
    return jaccard_join.near_groups(documents(spark, directory))


def op10_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, directory))


def op8_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    return toxicity.scores(docs, toxicity.fit(docs, labels))


def op5_merkle_fingerprint(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.compared(documents(spark, directory))


def op3_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return substring_dedup.without_passages(documents(spark, directory))


def op9_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(spark, directory))


def op6_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    coded = pieces.encoded(docs, pieces.Pieces())
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


def op4_lm_score(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    return lm_score.scores(docs, lm_score.fit(docs))


def op7_secret_scan(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    return secrets.scanned(docs, secrets.fit(docs))


def op11_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    rows = spark.read.parquet(f"{directory}/conversations.parquet")
    return conversations.audited(conversations.damaged(rows))


def op12_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.variants(documents(spark, directory))


def op13_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.packed(documents(spark, directory), public_tokenizers.path(packing.TOKENIZER))


ENTRIES: dict[str, Entry] = {
    "op1_source_mix": Entry(op1_source_mix, sql.MIXED),
    "op2_ngram_jaccard": Entry(op2_ngram_jaccard),
    "op10_exact_dedup": Entry(op10_exact_dedup, sql.EXACT),
    "op8_toxicity": Entry(op8_toxicity),
    "op5_merkle_fingerprint": Entry(op5_merkle_fingerprint),
    "op3_substring_dedup": Entry(op3_substring_dedup),
    "op9_suffix_dedup": Entry(op9_suffix_dedup),
    "op6_sentencepiece": Entry(op6_sentencepiece),
    "pipeline": Entry(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op4_lm_score": Entry(op4_lm_score),
    "op7_secret_scan": Entry(op7_secret_scan),
    "op11_conversation_repair": Entry(op11_conversation_repair, sql.REPAIRED),
    "op12_spelling_variants": Entry(op12_spelling_variants, sql.VARIANTS),
    "op13_packing": Entry(op13_packing),
}
