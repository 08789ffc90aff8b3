"""The corpus operators' queries, with their production parameters, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from acervo.llm import decontamination, divergence, exact, interaction, licenses, lines, maxent, mixing, quality, secrets, shards, simhash, substrings
from acervo.llm.common import table


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole=True)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_hex(simhash.grouped(table(spark, sf_dir, "documents")))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicated(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.diverging(table(spark, sf_dir, "documents"))


def op13_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_license_scan, op2_secret_scan, op3_mixing, op4_lm_scoring, op5_substring_dedup, op6_simhash_near_dedup, op7_token_output, op8_decontamination, op9_line_dedup, op10_quality_rules, op11_exact_dedup, op12_source_divergence, op13_filter_interaction)}


def oracle_sql() -> dict:
    return {"op1_license_scan": licenses.oracle_sql(), "op3_mixing": mixing.oracle_sql(), "op9_line_dedup": lines.oracle_sql(), "op11_exact_dedup": exact.oracle_sql(), "op12_source_divergence": divergence.oracle_sql(), "op13_filter_interaction": interaction.oracle_sql()}
