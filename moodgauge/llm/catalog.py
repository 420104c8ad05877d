"""The queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from moodgauge.llm import alignment, cross_entropy, exact, jaccard, language, mixing, neighbours, packing, ranked, rules, simhash, subwords, suffixes
from moodgauge.llm.tables import table


def op1_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"))


def op8_tree_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_neighbour_quality, op2_suffix_dedup, op3_cross_entropy, op4_source_mix, op5_jaccard_join, op6_subword_toxicity,
        op7_tiered_packing, op8_tree_rules, op9_exact_dedup, op10_language, op11_simhash_links,
        op12_token_alignment, op13_ranked_search,
    )
}

SQL: dict[str, str] = {"op4_source_mix": mixing.SQL, "op9_exact_dedup": exact.SQL, "op13_ranked_search": ranked.SQL}
