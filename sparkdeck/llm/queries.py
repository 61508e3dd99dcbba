"""The registered ``opN_<name>`` queries: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.llm import (ann, decontaminate, embedding_dedup, langid, lexical, licenses, neardup, packing, pages, resample,
                           secret_scan, tokens, toxicity)
from sparkdeck.llm.common import table


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the driver (its bytes travel with
    the tasks)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_permutation_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.classes(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_permutation_ann": op3_permutation_ann,
    "op4_language_id": op4_language_id,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_license_scan": op7_license_scan,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scan": op10_secret_scan,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": decontaminate.CONTAMINATION_SQL,
    "op7_license_scan": licenses.scan_sql(),
    "op11_importance_resampling": resample.RESAMPLE_SQL,
    "op13_lexical_search": lexical.SEARCH_SQL,
}
