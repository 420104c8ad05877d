"""Events to scoring requests, scored events to rows of the posts table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.moments import epoch_ms, now_ms
from moodgauge.operators.filters import RESPONSE_TYPES
from moodgauge.operators.ordering import last_per_key
from moodgauge.schemas import IMPACT, SCORE

POST_KEY = ["post_type", "post_id"]
ENVELOPE_VERSION = "20180514.1"


def wrap_event(data: Column, source, kind, data_source=None, received=None, schema="posts-common",
               version=ENVELOPE_VERSION, entity_id=1, entity_name="entity") -> Column:
    """The event envelope around a payload; `data_source` falls back to `source`."""

    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    origin = column(data_source).cast("string")
    return F.struct(
        column(schema).alias("schema"),
        column(version).alias("schemaVersion"),
        column(source).alias("source"),
        column(kind).alias("msgType"),
        (now_ms() if received is None else column(received)).alias("clientReceivedTsMs"),
        column(entity_id).alias("entityId"),
        column(entity_name).alias("entityName"),
        F.when(F.length(origin) > 0, origin).otherwise(column(source)).alias("dataSource"),
        data.alias("data"),
    )


def to_request(events: DataFrame) -> DataFrame:
    """Move `data.body` of stocktwits to `data.text` and mark the type as a scoring request."""
    data = F.col("data")
    text = F.when(F.col("msgType") == "stocktwit", data["body"]).otherwise(data["text"])
    return events.withColumn("data", data.withField("text", text).dropFields("body")).withColumn(
        "msgType", F.concat("msgType", F.lit("-sentiment-request"))
    )


def response_type(kind: Column) -> Column:
    return F.replace(kind, F.lit("request"), F.lit("response"))


def stored_type(kind: Column) -> Column:
    return F.replace(kind, F.lit("-sentiment-response"), F.lit(""))


def permalink(post_type: Column, user: Column, post_id: Column) -> Column:
    """Address of a post on its platform."""
    number = post_id.cast("string")
    return F.when(
        post_type == "stocktwit",
        F.concat(F.lit("https://stocktwits.com/"), user, F.lit("/message/"), number),
    ).otherwise(F.concat(F.lit("https://twitter.com/"), user, F.lit("/status/"), number))


def flatten(scored: DataFrame) -> DataFrame:
    """Scored events to posts rows; other types are left out, scores are rounded as they are stored."""
    kind = stored_type(F.col("msgType"))
    user = F.when(kind == "stocktwit", F.col("data.user.username")).otherwise(F.col("data.user.screen_name"))
    values = F.col("predictions.values")
    return scored.filter(F.col("msgType").isin(RESPONSE_TYPES)).select(
        kind.alias("post_type"),
        F.col("data.id").alias("post_id"),
        F.col("data.text").alias("body"),
        F.lit(1).cast(IMPACT).alias("impact"),
        permalink(kind, user, F.col("data.id")).alias("link"),
        user.alias("user_name"),
        epoch_ms(F.col("data.created_at")).alias("created_at_epoch_ms"),
        values["bull_sentiment"].try_cast(SCORE).alias("sentiment_ml_model"),
        values["vader_sentiment"].try_cast(SCORE).alias("sentiment_vader_normalized"),
        values["bull_vader_sentiment"].try_cast(SCORE).alias("sentiment_mixed"),
        F.col("clientReceivedTsMs").alias("client_received_epoch_ms"),
    )


def storable(posts: DataFrame) -> Column:
    """Rows the table accepts: its NOT NULL columns are set."""
    needed = ["post_type", "post_id", "link", "user_name", "created_at_epoch_ms", "client_received_epoch_ms"]
    verdict = F.lit(True)
    for name in needed:
        verdict = verdict & posts[name].isNotNull()
    return verdict


def latest_version(posts: DataFrame, order, keys=POST_KEY) -> DataFrame:
    """What an upsert by key leaves: the last arrival of every post."""
    return last_per_key(posts, list(keys), order)
