"""The corpus pipeline: from all documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from moodgauge.llm import exact, jaccard, mixing, neighbours, packing
from moodgauge.llm.tables import stored, table

# Texts go to Python in batches of at most so many bytes; an executor otherwise holds some 64 MB a task for them.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours vote to keep."""
    spark.conf.set(*ARROW_BATCH)
    return neighbours.good_only(docs, table(spark, sf_dir, "labels"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.without_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by near equal shingle sets."""
    spark.conf.set(*ARROW_BATCH)
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece, with its ids."""
    spark.conf.set(*ARROW_BATCH)
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("exact_dedup", keep_first_copies),
    ("jaccard_join", keep_one_of_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack),
]

# the classifier and the packing have no SQL form; tests compare the stages with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
