"""Registered queries of the text operators: each runs one operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.catalog import Query
from medallion.llm import (
    alignment, chat, decontamination, exact_dedup, language_id, line_dedup, lm_scoring, mixing,
    packing, simhash, token_counts, toxicity, whitening,
)
from medallion.llm.common import read_table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), WORD_BPE).drop("ids")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(
        read_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_counts(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op6_chat_formatting": Query(op6_chat_formatting, chat.SQL),
    "op5_benchmark_decontamination": Query(op5_benchmark_decontamination),
    "op8_lm_scoring": Query(op8_lm_scoring),
    "op3_language_id": Query(op3_language_id),
    "op7_toxicity": Query(op7_toxicity),
    "op4_simhash_near_dedup": Query(op4_simhash_near_dedup),
    "op2_exact_dedup": Query(op2_exact_dedup, exact_dedup.SQL),
    "op10_line_dedup": Query(op10_line_dedup, line_dedup.SQL),
    "op1_best_fit_packing": Query(op1_best_fit_packing),
    "op9_token_counts": Query(op9_token_counts),
    "op11_embedding_whitening": Query(op11_embedding_whitening),
    "op12_tokenizer_alignment": Query(op12_tokenizer_alignment),
    "op13_source_mixing": Query(op13_source_mixing, mixing.SQL),
}
