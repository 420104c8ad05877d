"""Posts to a labelled training corpus."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions import text as clean
from moodgauge.functions.moments import DAY_MS, since
from moodgauge.functions.numeric import TWEET_TYPES, numeric_label, repeat_factor
from moodgauge.operators.ordering import number_rows

#: Class names by label.
CLASS_NAMES = ["Bearish", "Bullish"]


def training_extract(posts: DataFrame, now, days: int = 14, kinds=TWEET_TYPES) -> DataFrame:
    """Recent posts of some types, the stored scores under their original names."""
    recent = posts.filter(since(F.col("created_at_epoch_ms"), now, days * DAY_MS) & F.col("post_type").isin(list(kinds)))
    return recent.select(
        "post_id", "post_type", "body", "impact", "link", "user_name",
        "created_at_epoch_ms", "client_received_epoch_ms",
        F.col("sentiment_ml_model").alias("original_ml_sentiment"),
        "sentiment_vader_normalized",
        F.col("sentiment_mixed").alias("original_sentiment_mixed"),
    )


def label_by_author(posts: DataFrame, accounts: DataFrame, how: str = "inner") -> DataFrame:
    """Give posts the camp of their author, matched by screen name.

    No broadcast hint: the planner broadcasts account lists it can see are small, and splits an author
    with very many posts in a shuffled join otherwise.
    """
    camps = accounts.select(F.col("screen_name").alias("user_name"), "id", "name", "sentiment")
    return posts.join(camps, "user_name", how)


def unknown_authors(posts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Authors in no camp with their number of posts, most active first.

    Counting comes before the anti-join, so a busy author is one row in it.
    """
    counts = posts.groupBy(F.col("user_name").alias("screen_name")).agg(F.count("*").alias("counts"))
    strangers = counts.join(accounts.select("screen_name").distinct(), "screen_name", "left_anti")
    return strangers.filter(F.col("screen_name").isNotNull()).orderBy(F.desc("counts"), "screen_name")


def override_label(posts: DataFrame, authors, label: str = "Bearish") -> DataFrame:
    sentiment = F.when(F.col("user_name").isin(list(authors)), F.lit(label)).otherwise(F.col("sentiment"))
    return posts.withColumn("sentiment", sentiment)


def repeat_rows(posts: DataFrame, times: Column) -> DataFrame:
    """Every row as often as its repeat factor says; a factor below one drops it."""
    copies = F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("_copy")
    return posts.select("*", copies).drop("_copy")


def label_posts(posts: DataFrame, accounts: DataFrame, overrides=()) -> DataFrame:
    """Author label, cleaned body, repeat factor and overrides, without duplicate rows."""
    labelled = label_by_author(posts, accounts)
    labelled = labelled.withColumn("clean_body", clean.clean_tweet(F.col("body")))
    labelled = labelled.withColumn("repeat", repeat_factor(F.col("impact")))
    return override_label(labelled, overrides).dropDuplicates()


def labelled_rows(corpus: DataFrame, sentiment: str = "sentiment", text: str = "clean_body") -> DataFrame:
    """Numeric labels, undetermined and unknown ones left out, text under its training name."""
    labels = corpus.withColumn("labels", numeric_label(F.col(sentiment)))
    return labels.filter("labels <> 2").withColumnRenamed(text, "text")


def unknown_label_rows(corpus: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    """The rows that `labelled_rows` leaves out because their label has no number, for a look at what they say."""
    return corpus.filter(numeric_label(F.col(sentiment)).isNull())


def unlabelled(corpus: DataFrame) -> DataFrame:
    """The language-model form: every label 0."""
    return corpus.withColumn("labels", F.lit(0))


def shift_labels(corpus: DataFrame, label: str = "labels") -> DataFrame:
    """Labels from 0, and how many classes there are."""
    low = corpus.agg(F.min(label).alias("v")).scalar()
    high = corpus.agg(F.max(label).alias("v")).scalar()
    return corpus.withColumn("n_classes", high - low + 1).withColumn(label, F.col(label) - low)


def class_balance(corpus: DataFrame, label: str = "labels") -> DataFrame:
    return corpus.agg(F.count("*").alias("n_rows"), F.avg((F.col(label) == 1).cast("double")).alias("share_of_1"))


def add_row_id(corpus: DataFrame, order: str, name: str = "id") -> DataFrame:
    """Gapless row id in the order of a unique integer column."""
    return number_rows(corpus, order, name)
