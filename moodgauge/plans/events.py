"""Events on their way into the posts table."""

from pyspark.sql import functions as F

from moodgauge import schemas
from moodgauge.operators import filters, posts
from moodgauge.plans import tables as t
from moodgauge.plans.registry import query
from moodgauge.session import scratch_path
from moodgauge.sources import readers, writers
from moodgauge.sources.store import PostStore
from moodgauge.streaming.stages import highest_positions

# words that some of the given texts hold
_WORDS = ["ouen", "tionere", "éeau", "unget"]
_WORDS_SQL = "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in _WORDS) + ")"
_WANTED = f"""
wanted AS (SELECT * FROM turns WHERE msgType IN ('stocktwit', 'twitter-topic', 'twitter-user')
  AND (msgType = 'stocktwit' OR ({_WORDS_SQL} AND NOT starts_with(lower(text), 'rt '))))"""


@query(
    "filter_posts",
    f"""WITH {t.TURNS}, {_WANTED}
SELECT msgType, text, split_part(msgType, '-', 1) AS platform, post_id AS id FROM wanted""",
)
def filter_posts(spark, sf_dir):
    kept = filters.wanted_posts(t.turns(spark, sf_dir), "msgType", "text", _WORDS)
    return filters.add_key(kept, "msgType", "post_id").select("msgType", "text", "platform", "id")


@query(
    "first_seen",
    f"""WITH {t.POST_EVENTS}, k AS (SELECT *, split_part(post_type, '-', 1) AS platform FROM p)
SELECT platform, message_id AS id, post_type, event_id, ms FROM k
QUALIFY row_number() OVER (PARTITION BY platform, message_id ORDER BY ms, event_id) = 1""",
)
def first_seen(spark, sf_dir):
    keyed = filters.add_key(t.post_events(spark, sf_dir), "post_type", "message_id")
    return filters.first_seen(keyed.select("platform", "id", "post_type", "event_id", "ms"), ["ms", "event_id"])


@query(
    "unseen_posts",
    f"""WITH {t.POST_EVENTS}, k AS (SELECT *, split_part(post_type, '-', 1) AS platform FROM p)
SELECT event_id, platform, message_id AS id FROM k WHERE (platform, message_id) NOT IN
  (SELECT (platform, message_id) FROM k, clock WHERE ms < now_ms - 20 * 86400000)""",
)
def unseen_posts(spark, sf_dir):
    versions = t.post_events(spark, sf_dir)
    stored = versions.filter(F.col("ms") < t.now(spark, sf_dir) - 20 * 86_400_000)
    keyed = filters.add_key(versions, "post_type", "message_id").select("event_id", "platform", "id")
    return filters.unseen(keyed, stored, "post_type", "message_id")


@query(
    "to_request",
    f"""WITH {t.TURNS}
SELECT msgType || '-sentiment-request' AS msgType, post_id AS id, text FROM turns""",
)
def to_request(spark, sf_dir):
    requests = posts.to_request(t.raw_posts(spark, sf_dir))
    assert "body" not in requests.schema["data"].dataType.fieldNames()
    return requests.select("msgType", "data.id", "data.text")


def score_by_id(requests):
    """Scores made from the post's id, so that the result is known."""
    number = F.col("data.id")
    bull, vader = (number % 103) / 102, (number % 107) / 106
    values = F.struct(
        (1 - bull).alias("bear_sentiment"), bull.alias("bull_sentiment"),
        vader.alias("vader_sentiment"), (bull * 0.8 + vader * 0.2).alias("bull_vader_sentiment"),
    )
    return requests.withColumn("predictions", F.struct(values.alias("values"))).withColumn(
        "msgType", posts.response_type(F.col("msgType"))
    )


_FLAT = f"""
flat AS (SELECT msgType AS post_type, post_id, text AS body,
    'https://' || CASE WHEN msgType = 'stocktwit' THEN 'stocktwits.com/user' || conv_id % 50 || '/message/'
                       ELSE 'twitter.com/user' || conv_id % 50 || '/status/' END || post_id AS link,
    'user' || conv_id % 50 AS user_name, {t.TURN_MS} AS created_at_epoch_ms,
    CAST(CAST((post_id % 103) / 102.0 AS DECIMAL(5,2)) AS DOUBLE) AS sentiment_ml_model,
    CAST(CAST((post_id % 107) / 106.0 AS DECIMAL(5,2)) AS DOUBLE) AS sentiment_vader_normalized,
    CAST(CAST(((post_id % 103) / 102.0) * CAST(0.8 AS DOUBLE) + ((post_id % 107) / 106.0) * CAST(0.2 AS DOUBLE)
         AS DECIMAL(5,2)) AS DOUBLE) AS sentiment_mixed,
    {t.TURN_MS} + 500 AS client_received_epoch_ms
  FROM turns WHERE msgType <> 'other')"""


@query("flatten_posts", f"WITH {t.TURNS}, {_FLAT} SELECT *, CAST(1 AS DOUBLE) AS impact FROM flat")
def flatten_posts(spark, sf_dir):
    rows = posts.flatten(score_by_id(posts.to_request(t.raw_posts(spark, sf_dir))))
    doubles = ["impact", "sentiment_ml_model", "sentiment_vader_normalized", "sentiment_mixed"]
    return rows.select(*[F.col(c).cast("double").alias(c) if c in doubles else c for c in rows.columns])


@query(
    "wrap_event",
    """SELECT 'posts-common' AS schema, '20180514.1' AS schemaVersion, event_type AS source, 'event' AS msgType,
  (epoch_us(ts) // 1000) AS clientReceivedTsMs, CAST(1 AS INTEGER) AS entityId, 'entity' AS entityName,
  CASE WHEN user_id % 2 = 0 THEN 'even' ELSE event_type END AS dataSource, event_id AS id, value FROM events""",
)
def wrap_event(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    other = F.when(F.col("user_id") % 2 == 0, "even")
    wrapped = posts.wrap_event(
        F.struct(F.col("event_id").alias("id"), "value"), F.col("event_type"), "event", other, t.event_ms()
    )
    return events.select(wrapped.alias("e")).select("e.*").select("*", "data.id", "data.value").drop("data")


def _raw_lines(spark, sf_dir):
    """Events as raw text records; some are blank, some are cut off."""
    events = t.table(spark, sf_dir, "events")
    line = F.to_json(
        F.struct(
            F.lit("posts-common").alias("schema"), F.col("event_type").alias("msgType"),
            t.event_ms().alias("clientReceivedTsMs"),
            F.struct(F.col("event_id").alias("id"), F.col("props").alias("text")).alias("data"),
        )
    )
    number = F.col("event_id")
    value = F.when(number % 11 == 3, "\n").when(number % 13 == 5, F.expr("left(line, length(line) - 4)"))
    return events.withColumn("line", line).select("event_id", value.otherwise(F.col("line")).alias("value"))


_GOOD = "event_id % 11 <> 3 AND event_id % 13 <> 5"


@query(
    "parse_records",
    f"""SELECT event_type AS msgType, (epoch_us(ts) // 1000) AS clientReceivedTsMs, event_id AS id, props AS text
FROM events WHERE {_GOOD}""",
)
def parse_records(spark, sf_dir):
    events = readers.good_events(readers.parse_records(_raw_lines(spark, sf_dir)))
    return events.select("msgType", "clientReceivedTsMs", "data.id", "data.text")


@query("quarantine", "SELECT event_id FROM events WHERE event_id % 11 <> 3 AND event_id % 13 = 5")
def quarantine(spark, sf_dir):
    events = readers.parse_records(_raw_lines(spark, sf_dir))
    return events.filter(F.col(readers.BAD_RECORD).isNotNull()).select("event_id")


_LINE = """'{"schema":"posts-common","msgType":"' || event_type || '","clientReceivedTsMs":' || (epoch_us(ts) // 1000)
  || ',"data":{"id":' || event_id || ',"text":"' || replace(props, '"', '\\"') || '"}}'"""


@query("canonical_lines", f"SELECT {_LINE} AS value FROM events WHERE {_GOOD}")
def canonical_lines(spark, sf_dir):
    return readers.canonical_lines(_raw_lines(spark, sf_dir))


@query(
    "keyed_records",
    f"""WITH l AS (SELECT event_id, {_LINE} AS line FROM events),
v AS (SELECT CASE WHEN event_id % 13 = 5 THEN left(line, length(line) - 4) ELSE line END AS value FROM l
      WHERE event_id % 11 <> 3)
SELECT md5(substr(value, 74, 127)) AS key, value FROM v""",
)
def keyed_records(spark, sf_dir):
    return writers.keyed_records(_raw_lines(spark, sf_dir))


_RECORDS = "records AS (SELECT user_id % 4 AS shard, event_id AS seq, event_id % 3 AS sub_seq, (epoch_us(ts) // 1000) AS ts FROM events)"


def _records(spark, sf_dir):
    return t.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4).alias("shard"), F.col("event_id").alias("seq"),
        (F.col("event_id") % 3).alias("sub_seq"), t.event_ms().alias("ts"),
    )


@query(
    "replay_from_position",
    f"""WITH {_RECORDS}, mid AS (SELECT max(seq) // 2 AS s, max(ts) - 86400000 AS m FROM records)
SELECT 'TRIM_HORIZON' AS position, * FROM records
UNION ALL SELECT 'AT_SEQUENCE_NUMBER', records.* FROM records, mid WHERE seq >= s
UNION ALL SELECT 'AFTER_SEQUENCE_NUMBER', records.* FROM records, mid WHERE seq > s
UNION ALL SELECT 'AT_TIMESTAMP', records.* FROM records, mid WHERE ts >= m
UNION ALL SELECT 'LATEST', records.* FROM records, mid WHERE seq > s""",
)
def replay_from_position(spark, sf_dir):
    records = _records(spark, sf_dir)
    middle = records.agg(F.floor(F.max("seq") / 2)).scalar()
    moment = records.agg(F.max("ts") - 86_400_000).scalar()
    starts = {
        "TRIM_HORIZON": None, "AT_SEQUENCE_NUMBER": middle, "AFTER_SEQUENCE_NUMBER": middle,
        "AT_TIMESTAMP": moment, "LATEST": middle,
    }
    found = None
    for position, value in starts.items():
        part = readers.replay_from(records, position, value).select(F.lit(position).alias("position"), "*")
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "highest_positions",
    f"""WITH {_RECORDS}
SELECT shard, seq, sub_seq FROM records QUALIFY row_number() OVER (PARTITION BY shard ORDER BY seq DESC, sub_seq DESC) = 1""",
)
def shard_positions(spark, sf_dir):
    return highest_positions(_records(spark, sf_dir))


@query(
    "event_file_scan",
    f"""SELECT event_type AS msgType, (epoch_us(ts) // 1000) AS clientReceivedTsMs, event_id AS id, props AS text
FROM events WHERE {_GOOD}""",
)
def event_file_scan(spark, sf_dir):
    """Raw records written to text files and read back as events."""
    path = scratch_path(spark, "event-files")
    _raw_lines(spark, sf_dir).select("value").write.text(path)
    events = readers.good_events(readers.read_events(spark, path))
    return events.select("msgType", "clientReceivedTsMs", "data.id", "data.text")


@query(
    "post_store_upsert",
    f"""WITH {t.POSTS}, s AS (SELECT *, post_id AS event_id, post_id % 500 AS key FROM posts)
SELECT post_type, key AS post_id, body, CAST(1 AS DOUBLE) AS impact, user_name, client_received_epoch_ms FROM s
QUALIFY row_number() OVER (PARTITION BY post_type, key ORDER BY event_id % 3 DESC, event_id DESC) = 1""",
)
def post_store_upsert(spark, sf_dir):
    """Three batches upserted by key; the second runs twice, as after a lost driver."""
    store = PostStore(spark, scratch_path(spark, "store"))
    versions = t.posts(spark, sf_dir).withColumn("link", F.lit("")).withColumn("impact", F.lit(1).cast(schemas.IMPACT))
    versions = versions.withColumn("event_id", F.col("post_id")).withColumn("post_id", F.col("post_id") % 500)
    for batch in (0, 1, 1, 2):
        part = versions.filter(F.col("event_id") % 3 == batch)
        store.append_posts(posts.latest_version(part, ["event_id"]).drop("event_id"), batch)
    kept = store.posts().withColumn("impact", F.col("impact").cast("double"))
    return kept.select("post_type", "post_id", "body", "impact", "user_name", "client_received_epoch_ms")
