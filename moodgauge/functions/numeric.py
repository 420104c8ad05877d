"""Score arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TWEET_TYPES = ["twitter-topic", "twitter-user"]


def impact(post_type: Column, likes: Column, interactions: Column) -> Column:
    """1 + likes + interactions; an interaction with a tweet counts three times."""
    weight = F.when(post_type.isin(TWEET_TYPES), 3).otherwise(1)
    return 1 + F.coalesce(likes, F.lit(0)) + weight * F.coalesce(interactions, F.lit(0))


def _once(value: Column, use) -> Column:
    """Evaluate `value` one time and hand it to `use`; a plain Column would be repeated per element."""
    return F.get(F.transform(F.array(value), use), 0)


def softmax(scores: Column) -> Column:
    """Row softmax of an array, shifted by its maximum."""

    def shares(exps):
        return _once(F.aggregate(exps, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(exps, lambda v: v / total))

    def exponentials(array):
        return _once(F.array_max(array), lambda top: F.transform(array, lambda v: F.exp(v - top)))

    return _once(scores.cast("array<double>"), lambda array: _once(exponentials(array), shares))


def argmax(scores: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def to_unit_range(score: Column) -> Column:
    """[-1, 1] to [0, 1]."""
    return (score + 1) / 2


def blend(model_score: Column, lexicon_score: Column, model_weight: float = 0.8) -> Column:
    """Weighted mean of the classifier's and the lexicon's score."""
    rest = round(1 - model_weight, 10)
    return model_score * F.lit(model_weight) + lexicon_score * F.lit(rest)


def repeat_factor(impact_value: Column) -> Column:
    """How often a post enters the training set: one, and one more per full 100 of impact."""
    return (impact_value.cast("double") / 100 + 1).cast("int")


def numeric_label(label: Column) -> Column:
    """Bearish 0, Bullish 1, Undetermined 2; anything else is null."""
    return F.when(label == "Bearish", 0).when(label == "Bullish", 1).when(label == "Undetermined", 2)
