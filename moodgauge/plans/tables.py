"""The given tables in the roles the operators work on, for Spark and as SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodgauge.functions.numeric import impact
from moodgauge.functions.text import words
from moodgauge.schemas import IMPACT, INDEX_VALUE, SCORE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ms(clock: str = "ts") -> Column:
    return F.unix_millis(F.col(clock).cast("timestamp"))


def post_events(spark, sf_dir) -> DataFrame:
    """Three kinds of events as versions of posts; a post has several versions."""
    kind = (
        F.when(F.col("event_type") == "purchase", "stocktwit")
        .when(F.col("event_type") == "click", "twitter-user")
        .when(F.col("event_type") == "view", "twitter-topic")
    )
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "click", "view"))
    return events.select(
        "event_id",
        "user_id",
        kind.alias("post_type"),
        (F.col("event_id") % 500).alias("message_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("interaction_total"),
        F.floor("value").cast("bigint").alias("likes_total"),
        event_ms().alias("ms"),
        ((F.col("event_id") % 101) / 100).cast(SCORE).alias("sentiment_mixed"),
    )


POST_EVENTS = """
p AS (SELECT event_id, user_id,
        CASE event_type WHEN 'purchase' THEN 'stocktwit' WHEN 'click' THEN 'twitter-user'
             ELSE 'twitter-topic' END AS post_type,
        event_id % 500 AS message_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS interaction_total,
        CAST(floor(value) AS BIGINT) AS likes_total,
        (epoch_us(ts) // 1000) AS ms,
        CAST((event_id % 101) / 100.0 AS DECIMAL(5,2)) AS sentiment_mixed
      FROM events WHERE event_type IN ('purchase', 'click', 'view')),
clock AS (SELECT max((epoch_us(ts) // 1000)) AS now_ms FROM events)"""


def now(spark, sf_dir) -> Column:
    """The last event's moment, as a scalar subquery."""
    return table(spark, sf_dir, "events").agg(F.max(event_ms())).scalar()


def posts(spark, sf_dir) -> DataFrame:
    """Every post event as a stored post of its own."""
    value = impact(F.col("post_type"), F.col("likes_total"), F.col("interaction_total"))
    return post_events(spark, sf_dir).select(
        "post_type",
        F.col("event_id").alias("post_id"),
        F.format_string("post %d of user %d", "event_id", "user_id").alias("body"),
        value.cast(IMPACT).alias("impact"),
        F.format_string("user%d", "user_id").alias("user_name"),
        F.col("ms").alias("created_at_epoch_ms"),
        ((F.col("event_id") % 89) / 100).cast(SCORE).alias("sentiment_ml_model"),
        ((F.col("event_id") % 97) / 100).cast(SCORE).alias("sentiment_vader_normalized"),
        "sentiment_mixed",
        (F.col("ms") + 1000).alias("client_received_epoch_ms"),
    )


POSTS = POST_EVENTS + """,
posts AS (SELECT post_type, event_id AS post_id,
        'post ' || event_id || ' of user ' || user_id AS body,
        CAST(1 + likes_total + CASE WHEN post_type = 'stocktwit' THEN 1 ELSE 3 END * interaction_total
             AS DECIMAL(10,2)) AS impact,
        'user' || user_id AS user_name, ms AS created_at_epoch_ms,
        CAST((event_id % 89) / 100.0 AS DECIMAL(5,2)) AS sentiment_ml_model,
        CAST((event_id % 97) / 100.0 AS DECIMAL(5,2)) AS sentiment_vader_normalized,
        sentiment_mixed, ms + 1000 AS client_received_epoch_ms
      FROM p)"""


def published(spark, sf_dir) -> DataFrame:
    """Every event as an index row published earlier."""
    kind = (
        F.when(F.col("event_type") == "purchase", "stocktwits")
        .when(F.col("event_type").isin("click", "view"), "twitter")
        .when(F.col("event_type") == "signup", "social_external_ensemble")
        .otherwise("news_external_ensemble")
    )
    return table(spark, sf_dir, "events").select(
        kind.alias("sentiment_type"),
        ((1 + F.col("event_id") % 5) * 21600).cast("bigint").alias("sentiment_seconds_back"),
        event_ms().alias("created_at_epoch_ms"),
        ((F.floor("value") - 50) / 100).cast(INDEX_VALUE).alias("sentiment_absolute"),
        F.lit(None).cast("decimal(5,3)").alias("sentiment_normalized"),
    )


PUBLISHED = """
published AS (SELECT
        CASE WHEN event_type = 'purchase' THEN 'stocktwits' WHEN event_type IN ('click', 'view') THEN 'twitter'
             WHEN event_type = 'signup' THEN 'social_external_ensemble' ELSE 'news_external_ensemble' END
          AS sentiment_type,
        (1 + event_id % 5) * 21600 AS sentiment_seconds_back, (epoch_us(ts) // 1000) AS created_at_epoch_ms,
        CAST((floor(value) - 50) / 100 AS DECIMAL(10,3)) AS sentiment_absolute
      FROM events)"""


def feeds(spark, sf_dir) -> dict[str, DataFrame]:
    """Signups as the two social feeds, errors as the two news feeds, split by user."""
    events = table(spark, sf_dir, "events").withColumn("ms", event_ms())
    events = events.withColumn("client_received_ts_ms", F.col("ms") - F.col("ms") % 3_600_000)
    events = events.withColumn("score", F.floor("value").cast("double"))
    even = F.col("user_id") % 2 == 0

    def side(kind, keep, name, score):
        rows = events.filter((F.col("event_type") == kind) & keep)
        return rows.select("client_received_ts_ms", score.alias(name))

    score = F.col("score")
    return {
        "sentiment_percent": side("signup", even, "sentiment_percent", score),
        "sentiment_score": side("signup", ~even, "sentiment_score", score * 2),
        "news_score": side("error", even, "news_sentiment_score", score),
        "buzz": side("error", ~even, "current_buzz", score),
    }


FEEDS = """
feeds AS (SELECT event_type, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 3600000 AS received, floor(value) AS score FROM events)"""


def accounts(spark, sf_dir) -> DataFrame:
    """Customers as accounts; their segments decide the lists they are on."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("user"), "c_custkey").alias("screen_name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
    )


ACCOUNTS = """
a AS (SELECT c_custkey AS id, c_name AS name, 'user' || c_custkey AS screen_name,
             c_mktsegment AS segment, c_nationkey AS nation FROM customer)"""


def texts(spark, sf_dir) -> DataFrame:
    """(doc_id, text)

    With the session's setting `moodgauge.scanPartitions` the scan is dealt to so many tasks, for a few small files before heavy
    per-row work; it is off unless set.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    wanted = spark.conf.get("moodgauge.scanPartitions", None)
    return docs.repartition(int(wanted), "doc_id") if wanted else docs


def documents(spark, sf_dir) -> DataFrame:
    """(doc_id, tokens)"""
    return texts(spark, sf_dir).select("doc_id", words(F.col("text")).alias("tokens"))


TOKENS = r"""
docs AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS tokens
         FROM documents),
tok AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM docs),
cnt AS (SELECT token, count(*) AS n FROM tok GROUP BY token)"""

VOCABULARY = TOKENS + """,
vocab AS (SELECT token, CAST(1 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id
          FROM (SELECT * FROM cnt WHERE n > 2 ORDER BY n DESC, token LIMIT 60000)
          UNION ALL SELECT '_unk_', 0 UNION ALL SELECT '_pad_', 1),
enc AS (SELECT doc_id, pos, coalesce(id, 0) AS id FROM tok LEFT JOIN vocab USING (token))"""


def turns(spark, sf_dir) -> DataFrame:
    """Conversation turns as post events; every fifth turn opens like a retweet."""
    kind = (
        F.when(F.col("role") == "user", "twitter-user").when(F.col("role") == "assistant", "twitter-topic")
        .when(F.col("conv_id") % 2 == 0, "stocktwit").otherwise("other")
    )
    post_id = F.col("conv_id") * 1000 + F.col("turn")
    text = F.when(F.col("turn") % 5 == 4, F.concat(F.lit("RT "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select(
        kind.alias("msgType"), post_id.alias("post_id"), text.alias("text"), "conv_id", "turn"
    )


TURNS = """
turns AS (SELECT CASE role WHEN 'user' THEN 'twitter-user' WHEN 'assistant' THEN 'twitter-topic'
                      ELSE CASE WHEN conv_id % 2 = 0 THEN 'stocktwit' ELSE 'other' END END AS msgType,
                 conv_id * 1000 + turn AS post_id,
                 CASE WHEN turn % 5 = 4 THEN 'RT ' || text ELSE text END AS text, conv_id, turn
          FROM conversations)"""


def raw_posts(spark, sf_dir) -> DataFrame:
    """Turns in the event envelope, as they arrive: stocktwits hold their text in `body`."""
    post = turns(spark, sf_dir)
    stocktwit = F.col("msgType") == "stocktwit"
    ms = F.lit(1_536_584_735_000) + F.col("post_id") * 1000
    author = F.concat(F.lit("user"), (F.col("conv_id") % 50).cast("string"))
    data = F.struct(
        F.col("post_id").alias("id"),
        F.when(stocktwit, F.col("text")).alias("body"),
        F.when(~stocktwit, F.col("text")).alias("text"),
        F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(
            F.when(stocktwit, author).alias("username"), F.when(~stocktwit, author).alias("screen_name")
        ).alias("user"),
    )
    return post.select(
        F.lit("posts-common").alias("schema"),
        F.lit("20180514.1").alias("schemaVersion"),
        F.when(stocktwit, "stocktwits-rt").otherwise("twitter-rt").alias("source"),
        "msgType",
        (ms + 500).alias("clientReceivedTsMs"),
        data.alias("data"),
    )


#: created_at of the turn with this id, in milliseconds
TURN_MS = "(1536584735000 + post_id * 1000)"
