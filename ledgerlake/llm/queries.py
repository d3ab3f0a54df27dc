"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, html_extract, jaccard_join, line_dedup, merkle, mixing, near_dedup, packing, phrases, quality,
               secret_scan, token_counts, toxicity)
from .common import table


def vocabulary(name: str) -> str:
    """The default place of a public tokenizer's file; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Settings(words=4))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op5_temperature_mixing(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op7_nearest(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op9_quality_rules(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op10_line_dedup(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.op12_merkle_manifest(table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents"), jaccard_join.Settings(words=4, percent=85))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extract": op1_html_extract,
        "op2_minhash_near_dedup": op2_minhash_near_dedup,
        "op3_token_counts": op3_token_counts,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_temperature_mixing": op5_temperature_mixing,
        "op6_secret_scan": op6_secret_scan,
        "op7_nearest_neighbours": op7_nearest_neighbours,
        "op8_toxicity": op8_toxicity,
        "op9_quality_rules": op9_quality_rules,
        "op10_line_dedup": op10_line_dedup,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_jaccard_join": op13_jaccard_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_temperature_mixing": mixing.op5_sql(),
        "op9_quality_rules": quality.op9_sql(),
        "op10_line_dedup": line_dedup.OP10_SQL,
        "op11_phrase_collocations": phrases.OP11_SQL,
        "op12_merkle_manifest": merkle.op12_sql(),
    }
