"""Exact random splits and samples that do not move the rows they label."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.operators.ordering import cutoff, shuffle_key


def split_rows(
    corpus: DataFrame, row_id: str, train: float = 0.75, validate: float = 0.0, seed: int = 0
) -> DataFrame:
    """Add `split`: int(train * m) rows train, int(validate * m) validate, the rest test.

    Rows are ordered by a hash of their unique id. The cut-off hashes are found on the id column
    alone; labelling the rows is then a comparison, without a shuffle.
    """
    keyed = corpus.withColumn("_key", shuffle_key(F.col(row_id), seed))
    keys = corpus.select(shuffle_key(F.col(row_id), seed).alias("key"))

    def share(part):
        return lambda total: F.floor(F.lit(float(part)) * total).cast("bigint")

    train_cut = cutoff(keys, share(train))
    split = F.when(F.col("_key") <= train_cut, "train")
    if validate:
        both = cutoff(keys, lambda total: share(train)(total) + share(validate)(total))
        split = split.when(F.col("_key") <= both, "validate")
    return keyed.withColumn("split", split.otherwise("test")).drop("_key")


def sample_rows(corpus: DataFrame, row_id: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows (all, if there are fewer) without replacement; samples of one seed are nested."""
    keys = corpus.select(shuffle_key(F.col(row_id), seed).alias("key"))
    cut = cutoff(keys, lambda total: F.least(F.lit(n).cast("bigint"), total))
    return corpus.filter(shuffle_key(F.col(row_id), seed) <= cut)


def language_model_split(train_texts: DataFrame, test_texts: DataFrame, row_id: str, test: float = 0.1, seed: int = 0):
    """All texts of both sets again, split anew, with the constant label of unlabelled text."""
    both = train_texts.unionByName(test_texts).withColumn("labels", F.lit(0))
    return split_rows(both, row_id, train=1 - test, seed=seed)
