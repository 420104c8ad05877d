"""Two-class text classifier over words and word pairs: log-count ratios per hashed feature, fitted by one aggregate.

A text's features are the buckets of its distinct words and pairs of adjacent words. A feature's ratio is the logarithm of its smoothed
share of the bull texts' features over that of the bear texts'; a text's score is the log prior plus the ratios of its features.
The table of ratios has one row per bucket at most, whatever the size of the corpus.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.text import words

BUCKETS = 1 << 18
ALPHA = 1.0
# a table of ratios of at most so many rows (16 bytes each) goes to every executor
BROADCAST_BUCKETS = 1 << 20


def bucket(feature: Column, buckets: int = BUCKETS) -> Column:
    """The first eight hex digits of the MD5 sum, modulo the number of buckets."""
    return F.conv(F.substring(F.md5(feature.cast("binary")), 1, 8), 16, 10).cast("bigint") % buckets


def features(text: Column, buckets: int = BUCKETS) -> Column:
    """The distinct buckets of the words and of the pairs of adjacent words; a null text has none."""
    tokens = words(F.coalesce(text, F.lit("")))
    following = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(tokens, F.lit(1), F.size(following)), following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.transform(F.concat(tokens, pairs), lambda x: bucket(x, buckets)))


def fit(corpus: DataFrame, text: str = "text", label: str = "labels", buckets: int = BUCKETS, alpha: float = ALPHA) -> DataFrame:
    """(feature, bull, bear, ratio) of the features found in texts labelled 1 (bull) or 0 (bear); other labels are left out."""
    marked = corpus.filter(F.col(label).isin(0, 1)).select(F.col(label).alias("of"), F.explode(features(F.col(text), buckets)).alias("feature"))
    counts = marked.groupBy("feature").agg(F.count_if(F.col("of") == 1).alias("bull"), F.count_if(F.col("of") == 0).alias("bear"))
    totals = counts.agg(*[(F.coalesce(F.sum(c), F.lit(0)) + F.lit(alpha * buckets)).alias(f"all_{c}") for c in ("bull", "bear")]).first()
    share = [(F.col(c) + F.lit(alpha)) / F.lit(totals[f"all_{c}"]) for c in ("bull", "bear")]
    return counts.select("feature", "bull", "bear", F.log(share[0] / share[1]).alias("ratio"))


def prior(corpus: DataFrame, label: str = "labels", alpha: float = ALPHA) -> float:
    """The logarithm of bull texts over bear texts, smoothed."""
    labels = [F.count_if(F.col(label) == x) + F.lit(alpha) for x in (1, 0)]
    return corpus.agg(F.log(labels[0] / labels[1])).first()[0]


def score(posts: DataFrame, ratios: DataFrame, bias: float, row_id: str, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(row_id, score, prediction): one row per id; prediction is 1 where the score is above 0.

    Each task sums its own rows before the shuffle, so one row per text leaves it. Features that are in no ratio add nothing.
    """
    known = ratios.select(F.col("feature").alias("of"), "ratio")
    found = posts.select(row_id, F.explode_outer(features(F.col(text), buckets)).alias("feature"))
    joined = found.join(F.broadcast(known) if buckets <= BROADCAST_BUCKETS else known, F.col("feature") == F.col("of"), "left")
    total = joined.groupBy(row_id).agg((F.coalesce(F.sum("ratio"), F.lit(0.0)) + F.lit(bias)).alias("score"))
    return total.select(row_id, "score", (F.col("score") > 0).cast("int").alias("prediction"))
