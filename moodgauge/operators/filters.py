"""Which events reach scoring, and which rows are well-formed."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.numeric import TWEET_TYPES
from moodgauge.operators.ordering import first_per_key

# The event types that are scored, and the words one of which a tweet must contain.
POST_TYPES = ["stocktwit", "twitter-topic", "twitter-user"]
KEYWORDS = ["elon musk", "tesla", "tsla", "tslaq", "elonmusk", "model 3"]
RETWEET_PREFIX = "rt "
RESPONSE_TYPES = [f"{kind}-sentiment-response" for kind in POST_TYPES]


def is_post_type(kind: Column, kinds=POST_TYPES) -> Column:
    return kind.isin(list(kinds))


def mentions_any(text: Column, keywords=KEYWORDS) -> Column:
    """Substring match on the lower-cased text, not word match."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(word) for word in keywords])


def is_retweet(text: Column, prefix: str = RETWEET_PREFIX) -> Column:
    return F.lower(text).startswith(prefix)


def platform(kind: Column) -> Column:
    """The text before the first dash, so that both tweet types share one key space."""
    return F.substring_index(kind, "-", 1)


def wanted_posts(events: DataFrame, kind: str, text: str, keywords=KEYWORDS) -> DataFrame:
    """Scored types only; tweets must mention a keyword and must not be retweets."""
    body = F.col(text)
    tweet_ok = mentions_any(body, keywords) & ~is_retweet(body)
    return events.filter(
        is_post_type(F.col(kind)) & F.when(F.col(kind).isin(TWEET_TYPES), tweet_ok).otherwise(True)
    )


def add_key(events: DataFrame, kind: str, post_id: str) -> DataFrame:
    return events.withColumn("platform", platform(F.col(kind))).withColumn("id", F.col(post_id))


def first_seen(events: DataFrame, order, keys=("platform", "id")) -> DataFrame:
    """The first arrival of every key."""
    return first_per_key(events, list(keys), order)


def unseen(events: DataFrame, stored: DataFrame, kind: str = "post_type", post_id: str = "post_id") -> DataFrame:
    """Drop events (with `platform`, `id`) whose post is stored already, under any type of the platform."""
    known = stored.select(platform(F.col(kind)).alias("platform"), F.col(post_id).alias("id"))
    # the stored side is thinned to one row per key before it is shuffled
    return events.join(known.distinct(), ["platform", "id"], "left_anti")


def not_blank(value: Column) -> Column:
    return F.length(F.trim(F.regexp_replace(value, r"[\r\n\t]", " "))) > 0


def split_bad_rows(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows); a null verdict counts as bad."""
    verdict = F.coalesce(ok, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)
