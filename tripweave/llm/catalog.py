"""The registered queries of the corpus operators and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import (
    classifier,
    debruijn,
    decontaminate,
    jaccard,
    lattice,
    licenses,
    lines,
    periods,
    quality,
    secrets,
    spellings,
    suffixes,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": lambda spark, sf_dir: lines.report(documents(spark, sf_dir)),
    "op2_substring_dedup": lambda spark, sf_dir: debruijn.report(documents(spark, sf_dir)),
    "op3_sentencepiece": lambda spark, sf_dir: lattice.report(documents(spark, sf_dir)),
    "op4_token_counts": lambda spark, sf_dir: token_counts.counts(documents(spark, sf_dir)),
    "op5_suffix_array_dedup": lambda spark, sf_dir: suffixes.report(documents(spark, sf_dir)),
    "op6_license_scan": lambda spark, sf_dir: licenses.scan(documents(spark, sf_dir)),
    "op7_secret_scan": lambda spark, sf_dir: secrets.scan(documents(spark, sf_dir)),
    "op8_quality_rules": lambda spark, sf_dir: quality.report(documents(spark, sf_dir)),
    "op9_benchmark_decontamination": lambda spark, sf_dir: decontaminate.matches(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")),
    "op10_ngram_jaccard_join": lambda spark, sf_dir: jaccard.report(documents(spark, sf_dir)),
    "op11_spelling_variants": lambda spark, sf_dir: spellings.groups(documents(spark, sf_dir)),
    "op12_quality_classifier": lambda spark, sf_dir: classifier.report(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")),
    "op13_periodic_runs": lambda spark, sf_dir: periods.scan(documents(spark, sf_dir)),
}

SQL: dict[str, str] = {
    "op1_line_dedup": lines.SQL,
    "op2_substring_dedup": debruijn.SQL,
    "op8_quality_rules": quality.SQL,
    "op10_ngram_jaccard_join": jaccard.SQL,
    "op11_spelling_variants": spellings.SQL,
}
