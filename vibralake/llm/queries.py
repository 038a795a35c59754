"""Queries opN_<name> of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vibralake.llm import ann, bpe, chat, exact_dedup, line_dedup, mixing, ngram_join, quality, secrets, substring
from vibralake.llm.shared import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.digest(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality": op5_quality,
    "op6_bpe": op6_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_chat_format": op9_chat_format,
    "op10_nearest": op10_nearest,
}
SQL = {
    "op1_secret_scan": secrets.SQL,
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op7_substring_dedup": substring.SQL,
    "op8_ngram_join": ngram_join.SQL,
    "op9_chat_format": chat.SQL,
}
