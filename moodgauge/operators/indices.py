"""Time-windowed sentiment indices over posts and external feeds."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.moments import DAY_MS, HOUR_MS, LOOK_BACK_SECONDS, as_ms, since
from moodgauge.operators.ordering import running_totals
from moodgauge.schemas import GLOBAL_SENTIMENT, INDEX_VALUE

# Which post types make up a platform, and the names of the external indices.
PLATFORMS = {"stocktwits": ["stocktwit"], "twitter": ["twitter-topic", "twitter-user"]}
SOCIAL_EXTERNAL = "social_external_ensemble"
NEWS_EXTERNAL = "news_external_ensemble"
GLOBAL_EXTERNAL = "global_external_ensemble"
#: Name of the index that combines the platforms.
COMBINED = "social_combined"


def weighted_sentiment() -> Column:
    """Impact times the signed distance from neutral, exact in decimals."""
    return F.col("impact") * (F.col("sentiment_mixed") - F.lit("0.5").cast("decimal(2,1)"))


def platform_of(post_type: Column) -> Column:
    named = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, kinds in PLATFORMS.items():
        named = named.when(post_type.isin(kinds), name)
    return named


def _rows(df: DataFrame, kind: Column, seconds: Column, now, value: Column) -> DataFrame:
    return df.select(
        kind.alias("sentiment_type"),
        seconds.cast("bigint").alias("sentiment_seconds_back"),
        as_ms(now).alias("created_at_epoch_ms"),
        value.try_cast(INDEX_VALUE).alias("sentiment_absolute"),  # null if it does not fit
        F.lit(None).cast(GLOBAL_SENTIMENT["sentiment_normalized"].dataType).alias("sentiment_normalized"),
    )


def platform_sentiment(posts: DataFrame, now, seconds: int = LOOK_BACK_SECONDS) -> DataFrame:
    """One row per platform, null where the look-back holds none of its posts. One scan for all."""
    recent = posts.filter(since(F.col("created_at_epoch_ms"), now, seconds * 1000))
    means = recent.agg(
        *[
            F.avg(F.when(F.col("post_type").isin(kinds), weighted_sentiment())).alias(name)
            for name, kinds in PLATFORMS.items()
        ]
    )
    long = means.select(
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("kind"), F.col(name).alias("mean")) for name in PLATFORMS])
        ).alias("r")
    )
    return _rows(long, F.col("r.kind"), F.lit(seconds), now, F.col("r.mean"))


def combined_index(published: DataFrame, now, name: str = COMBINED) -> DataFrame:
    """50 * mean(0.5 + platform sentiment) per look-back length, each row using its own length."""
    recent = published.filter(
        F.col("sentiment_type").isin(list(PLATFORMS))
        & since(F.col("created_at_epoch_ms"), now, F.col("sentiment_seconds_back") * 1000)
    )
    means = recent.groupBy("sentiment_seconds_back").agg(
        (50 * F.avg(F.lit("0.5").cast("decimal(2,1)") + F.col("sentiment_absolute"))).alias("mean")
    )
    return _rows(means, F.lit(name), F.col("sentiment_seconds_back"), now, F.col("mean"))


def feed_ensemble(feeds, now, name: str, seconds: int = LOOK_BACK_SECONDS) -> DataFrame:
    """Mean over several feeds of (client_received_ts_ms, score), each with its scale factor.

    Equal (moment, score) pairs count once, also across feeds.
    """
    sides = [
        df.filter(since(F.col("client_received_ts_ms"), now, seconds * 1000)).select(
            "client_received_ts_ms", (F.lit(float(scale)) * F.col(score).cast("double")).alias("score")
        )
        for df, score, scale in feeds
    ]
    mean = reduce(DataFrame.unionByName, sides).distinct().agg(F.avg("score").alias("mean"))
    return _rows(mean, F.lit(name), F.lit(seconds), now, F.col("mean"))


def social_ensemble(sentiment_percent: DataFrame, sentiment_score: DataFrame, now) -> DataFrame:
    """Two social feeds; the second runs from 0 to 200 and is halved."""
    feeds = [(sentiment_percent, "sentiment_percent", 1.0), (sentiment_score, "sentiment_score", 0.5)]
    return feed_ensemble(feeds, now, SOCIAL_EXTERNAL)


def news_ensemble(news_score: DataFrame, buzz: DataFrame, now) -> DataFrame:
    feeds = [(news_score, "news_sentiment_score", 1.0), (buzz, "current_buzz", 1.0)]
    return feed_ensemble(feeds, now, NEWS_EXTERNAL)


def external_ensemble(published: DataFrame, now, seconds: int = LOOK_BACK_SECONDS) -> DataFrame:
    """Mean of the recent rows of both external indices."""
    recent = published.filter(
        F.col("sentiment_type").isin(NEWS_EXTERNAL, SOCIAL_EXTERNAL)
        & since(F.col("created_at_epoch_ms"), now, seconds * 1000)
    )
    mean = recent.agg(F.avg("sentiment_absolute").alias("mean"))
    return _rows(mean, F.lit(GLOBAL_EXTERNAL), F.lit(seconds), now, F.col("mean"))


def publish_all(posts, published, feeds, now, combined_name: str = COMBINED) -> DataFrame:
    """Every index of one moment. Later ones see the earlier ones' rows.

    `feeds` holds the four external tables: sentiment_percent, sentiment_score, news_score, buzz.
    """
    platforms = platform_sentiment(posts, now)
    combined = combined_index(published.unionByName(platforms), now, combined_name)
    social = social_ensemble(feeds["sentiment_percent"], feeds["sentiment_score"], now)
    news = news_ensemble(feeds["news_score"], feeds["buzz"], now)
    external = external_ensemble(published.unionByName(social).unionByName(news), now)
    return reduce(DataFrame.unionByName, [platforms, combined, social, news, external])


def trailing_sentiment(posts: DataFrame, hours: int = 12) -> DataFrame:
    """Platform sentiment at every moment a post of the platform was created.

    A post adds its weight when it appears and takes it back just after the look-back ends, so the
    window is one running total over such steps. Steps are summed per millisecond first and then
    ordered in minute blocks, which bounds what one task orders. Decimal sums keep it exact.
    """
    weight = weighted_sentiment()
    rated = F.when(weight.isNotNull(), 1).otherwise(0)

    def step(ms, sign):
        return F.struct(
            ms.alias("ms"),
            (sign * F.coalesce(weight, F.lit(0))).cast("decimal(24,4)").alias("weight"),
            (sign * rated).cast("bigint").alias("rated"),
            F.lit(int(sign > 0)).cast("bigint").alias("entered"),
            F.lit(int(sign < 0)).cast("bigint").alias("left"),
        )

    created = F.col("created_at_epoch_ms")
    both = F.array(step(created, 1), step(created + hours * HOUR_MS + 1, -1))
    steps = posts.select(platform_of(F.col("post_type")).alias("platform"), F.explode(both).alias("s"))
    steps = steps.filter(F.col("platform").isNotNull()).select("platform", "s.*")
    # every use below needs all four sums, so that the planner finds one exchange to share
    values = ["weight", "rated", "entered", "left"]
    sums = [F.sum("weight").try_cast("decimal(24,4)").alias("weight"), *[F.sum(v).alias(v) for v in values[1:]]]
    steps = steps.groupBy("platform", "ms").agg(*sums)
    steps = running_totals(steps, "ms", {v: f"{v}_before" for v in values}, by=["platform"], width=60_000)
    now = {v: F.col(v) + F.col(f"{v}_before") for v in values}
    return steps.filter("entered > 0").select(
        "platform",
        F.col("ms").alias("created_at_epoch_ms"),
        (now["entered"] - now["left"]).alias("n_posts"),
        F.when(now["rated"] > 0, now["weight"].try_cast("decimal(24,4)") / now["rated"])
        .try_cast(INDEX_VALUE)
        .alias("sentiment_absolute"),
    )


def backfill_seconds_back(published: DataFrame, now, value: int = 3 * 3600 * 1000, days: int = 60) -> DataFrame:
    """Set the look-back length of rows from the last days. The default is in milliseconds, as stored."""
    fresh = since(F.col("created_at_epoch_ms"), now, days * DAY_MS)
    return published.withColumn(
        "sentiment_seconds_back",
        F.when(fresh, F.lit(value).cast("bigint")).otherwise(F.col("sentiment_seconds_back")),
    )
