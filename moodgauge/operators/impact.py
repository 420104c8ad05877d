"""Engagement-weighted impact of stored posts."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions import numeric
from moodgauge.functions.moments import HOUR_MS, since
from moodgauge.operators.ordering import with_previous
from moodgauge.schemas import IMPACT

KEY = ["post_type", "message_id"]


def engagement(stocktwits: DataFrame, user_tweets: DataFrame, topic_tweets: DataFrame) -> DataFrame:
    """The three raw tables under one schema. MAX follows, so duplicates may stay."""

    def side(df, kind, post_id, interactions, likes):
        return df.select(
            F.lit(kind).alias("post_type"),
            F.col(post_id).alias("message_id"),
            F.col(interactions).alias("interaction_total"),
            F.col(likes).alias("likes_total"),
        )

    tweet = ("tweet_id", "retweet_count", "favorite_count")
    return reduce(
        DataFrame.unionByName,
        [
            side(stocktwits, "stocktwit", "message_id", "conversation_replies", "likes_total"),
            side(user_tweets, "twitter-user", *tweet),
            side(topic_tweets, "twitter-topic", *tweet),
        ],
    )


def relevant_engagement(raw: DataFrame, posts: DataFrame, now, hours: int = 12) -> DataFrame:
    """Highest counters per post that is stored and created in the look-back.

    The counters are aggregated first, so a post with very many versions meets the semi-join as one
    row, and the join reuses the aggregate's partitioning.
    """
    recent = posts.filter(since(F.col("created_at_epoch_ms"), now, hours * HOUR_MS))
    recent = recent.select("post_type", F.col("post_id").alias("message_id")).distinct()
    highest = raw.groupBy(*KEY).agg(
        F.max("interaction_total").alias("interaction_total"), F.max("likes_total").alias("likes_total")
    )
    return highest.join(recent, KEY, "left_semi")


def with_impact(relevant: DataFrame) -> DataFrame:
    """Add the impact; it is null where counters are too large to store, which fails that row only."""
    value = numeric.impact(F.col("post_type"), F.col("likes_total"), F.col("interaction_total"))
    return relevant.withColumn("impact", value.try_cast(IMPACT))


def changed(current: DataFrame, previous: DataFrame, values=("interaction_total", "likes_total")) -> DataFrame:
    """Rows of `current` that are new or differ from `previous`, per (post_type, message_id)."""
    before = previous.select(*KEY, F.struct(*values).alias("_before"))
    joined = current.join(before, KEY, "left")
    return joined.filter(~F.struct(*values).eqNullSafe(F.col("_before"))).drop("_before")


def apply_impact(posts: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the impact of the posts named in `updates`; the others keep theirs."""
    new = updates.select("post_type", F.col("message_id").alias("post_id"), F.col("impact").alias("_new"))
    joined = posts.join(new, ["post_type", "post_id"], "left")
    return joined.select(
        *[F.coalesce("_new", "impact").cast(IMPACT).alias(c) if c == "impact" else F.col(c) for c in posts.columns]
    )


def changed_versions(versions: DataFrame, order, values, slice_by: Column, keys=KEY) -> DataFrame:
    """Versions that differ from the one before them (the first of a post counts as a change)."""
    seen = with_previous(versions, list(keys), order, values, slice_by)
    return seen.filter(~F.struct(*[F.col(c) for c in values]).eqNullSafe(F.col("previous"))).drop("previous")
