"""The registered queries of the text operators; their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (alignment, bytepairs, exactdedup, linededup, lm, oracle, packing, pieces,
                          prefixtrie, quality, sentencepieces, simhash, suffixdedup, urlfilter)
from basketry.llm.common import read_documents


def op1_token_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_documents(spark, folder))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(spark.read.parquet(f"{folder}/pages.parquet"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.line_report(read_documents(spark, folder))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.mark_copies(read_documents(spark, folder))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, folder))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.encode(read_documents(spark, folder))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixdedup.passage_report(read_documents(spark, folder))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(read_documents(spark, folder))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(pieces.power_of_two_pieces(read_documents(spark, folder)))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read_documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bytepairs.digests(bytepairs.decode(bytepairs.encode(read_documents(spark, folder))))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(read_documents(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_packing, op2_url_filter, op3_line_dedup, op4_exact_dedup, op5_simhash,
             op6_sentencepiece, op7_suffix_dedup, op8_lm_scoring, op9_packing, op10_quality_rules,
             op11_prefix_trie, op12_byte_bpe, op13_alignment)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
