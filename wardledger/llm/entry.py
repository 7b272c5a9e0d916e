"""The query of each operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    decontamination,
    exact_dedup,
    jaccard,
    language_id,
    lexical_search,
    lm_scoring,
    mixing,
    packing,
    repair,
    substring,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeated_passages(_documents(spark, folder))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_documents(spark, folder))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.predict_languages(_documents(spark, folder))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{folder}/pages.parquet"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontaminate(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op6_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return repair.encode_documents(_documents(spark, folder))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, folder))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(_documents(spark, folder))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_documents(spark, folder))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, folder))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(_documents(spark, folder))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_token_output": op6_token_output,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_packing": op11_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE_SQL: dict[str, str] = {
    "op4_warc": warc.ORACLE_SQL,
    "op5_decontamination": decontamination.ORACLE_SQL,
    "op7_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op13_lexical_search": lexical_search.ORACLE_SQL,
}
