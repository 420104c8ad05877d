"""Streaming forms, each run to the end of its input and compared with the batch form."""

from pyspark.sql import functions as F

from moodgauge.plans import tables as t
from moodgauge.plans.events import _WANTED, _WORDS, score_by_id
from moodgauge.plans.registry import query
from moodgauge.plans.sentiment import _mean3, _thousandths
from moodgauge.schemas import INDEX_VALUE
from moodgauge.session import scratch_path
from moodgauge.sources import readers, writers
from moodgauge.sources.store import PostStore
from moodgauge.streaming import changes, panes, stages


def _landed_turns(spark, sf_dir):
    """Folder of JSON events: all turns, then every seventh a second time, received later."""
    path = scratch_path(spark, "turns")
    raw = t.raw_posts(spark, sf_dir)
    writers.write_event_lines(raw, path)
    again = raw.filter(F.col("data.id") % 7 == 0)
    again = again.withColumn("clientReceivedTsMs", F.col("clientReceivedTsMs") + 5000)
    writers.write_event_lines(again, path)
    return path


def _run(writer):
    query_run = writer.start()
    query_run.awaitTermination()


@query("stream_filter", f"WITH {t.TURNS}, {_WANTED} SELECT msgType, post_id AS id, text FROM wanted "
       "UNION ALL SELECT msgType, post_id, text FROM wanted WHERE post_id % 7 = 0")
def stream_filter(spark, sf_dir):
    """Type, keyword and retweet filters on a stream, landed as JSON lines."""
    events = readers.stream_events(spark, _landed_turns(spark, sf_dir), files_per_trigger=8)
    out = scratch_path(spark, "filtered")
    requests = stages.request_stage(stages.filter_stage(events, _WORDS))
    _run(stages.land(requests, out, scratch_path(spark, "state")))
    landed = readers.read_events(spark, out)
    kind = F.replace("msgType", F.lit("-sentiment-request"), F.lit(""))
    return landed.select(kind.alias("msgType"), "data.id", "data.text")


@query(
    "stream_dedup",
    f"WITH {t.POST_EVENTS} SELECT DISTINCT split_part(post_type, '-', 1) AS platform, message_id AS id FROM p",
)
def stream_dedup(spark, sf_dir):
    """Keys let through by stateful de-duplication."""
    path, out = scratch_path(spark, "versions"), scratch_path(spark, "unique")
    keyed = t.post_events(spark, sf_dir).select(
        F.substring_index("post_type", "-", 1).alias("platform"), F.col("message_id").alias("id"), "ms"
    )
    keyed.repartition(4, "ms").write.json(path)
    stream = spark.readStream.schema("platform string, id bigint, ms bigint").option("maxFilesPerTrigger", 2).json(path)
    unique = stages.deduplicate(stream).select("platform", "id")
    _run(stages.land(unique, out, scratch_path(spark, "state")))
    return spark.read.schema("platform string, id bigint").json(out)


@query(
    "stream_sliding_sentiment",
    f"""WITH {t.POSTS},
r AS (SELECT CASE WHEN post_type = 'stocktwit' THEN 'stocktwits' ELSE 'twitter' END AS sentiment_type,
        CAST(impact * (sentiment_mixed - 0.5) * 10000 AS BIGINT) AS v, (created_at_epoch_ms // 21600000 - k) * 21600000 AS start_ms
      FROM posts, (VALUES (0), (1)) w(k))
SELECT sentiment_type, start_ms, start_ms + 43200000 AS end_ms,
       sign(sum(v)) * ((2 * abs(sum(v)) + 10 * count(*)) // (20 * count(*))) / 1000.0 AS sentiment_absolute
FROM r GROUP BY sentiment_type, start_ms""",
)
def stream_sliding_sentiment(spark, sf_dir):
    """Twelve-hour windows every six hours over a stream of posts."""
    path, out = scratch_path(spark, "posts"), scratch_path(spark, "windows")
    rows = t.posts(spark, sf_dir).select("post_type", "impact", "sentiment_mixed", "created_at_epoch_ms")
    rows.repartition(4, "created_at_epoch_ms").write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
    stream = stream.withColumn("created_at", F.timestamp_millis("created_at_epoch_ms"))
    windows = stages.sliding_sentiment(stream, "created_at", "6 hours", delay="3650 days")
    last = windows.select(
        "sentiment_type", F.unix_millis("window.start").alias("start_ms"), F.unix_millis("window.end").alias("end_ms"),
        F.col("sentiment_absolute").cast(INDEX_VALUE).cast("double").alias("sentiment_absolute"),
    )
    _run(
        last.writeStream.outputMode("complete")
        .foreachBatch(lambda df, batch_id: df.write.mode("overwrite").parquet(out))
        .option("checkpointLocation", scratch_path(spark, "state"))
        .trigger(availableNow=True)
    )
    return spark.read.parquet(out)


@query(
    "stream_trailing_panes",
    f"""WITH {t.POSTS},
pane AS (SELECT CASE WHEN post_type = 'stocktwit' THEN 'stocktwits' ELSE 'twitter' END AS sentiment_type,
        (created_at_epoch_ms // 30000 + 1) * 30000 AS pane_end, CAST(sum(CAST(impact * (sentiment_mixed - 0.5) * 10000 AS BIGINT)) AS BIGINT) AS v,
        count(*) AS n
      FROM posts GROUP BY ALL),
w AS (SELECT sentiment_type, pane_end + k * 30000 AS end_ms, CAST(sum(v) AS BIGINT) AS v, CAST(sum(n) AS BIGINT) AS n
      FROM pane, range(1440) g(k) GROUP BY ALL)
SELECT sentiment_type, end_ms, n AS n_posts, sign(v) * ((2 * abs(v) + 10 * n) // (20 * n)) / 1000.0 AS sentiment_absolute
FROM w WHERE end_ms <= (SELECT max(created_at_epoch_ms) - 43200000 FROM posts)""",
)
def stream_trailing_panes(spark, sf_dir):
    """Twelve-hour sentiment every 30 seconds over a stream in four parts, every tenth post six hours late."""
    path, out = scratch_path(spark, "posts"), scratch_path(spark, "panes")
    rows = t.posts(spark, sf_dir).select("post_id", "post_type", "impact", "sentiment_mixed", "created_at_epoch_ms")
    received = F.col("created_at_epoch_ms") + F.when(F.col("post_id") % 10 == 0, 6 * 3_600_000).otherwise(0)
    first, last = rows.agg(F.min(received), F.max(received)).first()
    quarter = F.floor((received - first) * 4 / (last - first + 1))
    for part in range(4):
        rows.filter(quarter == part).coalesce(1).write.mode("append").parquet(path)
    stream = changes.with_state_store(spark).readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream = stream.withColumn("created_at", F.timestamp_millis("created_at_epoch_ms"))
    borders = panes.trailing_panes(stream, "created_at").withColumn("sentiment_absolute", F.col("sentiment_absolute").cast("double"))
    _run(borders.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True))
    return spark.read.parquet(out)


def _ingested(spark, sf_dir):
    """Store after the whole stream went through, and the moment of its last post."""
    source = _landed_turns(spark, sf_dir)
    store = PostStore(spark, scratch_path(spark, "store"))
    turns = t.turns(spark, sf_dir)
    moment = F.lit(1_536_584_735_000) + F.col("post_id") * 1000
    now = turns.agg(F.max(moment)).first()[0]
    counters = turns.select(
        F.col("msgType").alias("post_type"), F.col("post_id").alias("message_id"),
        (F.col("turn") * 3).alias("interaction_total"), (F.col("conv_id") % 40).alias("likes_total"),
        moment.alias("received"),
    )

    def engagement(from_ms):
        return counters.filter(F.col("received") >= from_ms).drop("received")

    def feeds(from_ms):
        return {k: df.filter(F.col("client_received_ts_ms") >= from_ms) for k, df in t.feeds(spark, sf_dir).items()}

    ingest = stages.Ingest(store, score_by_id, engagement, feeds, now, _WORDS)
    events = readers.stream_events(spark, source, files_per_trigger=4)
    _run(ingest.writer(events, scratch_path(spark, "state"), every=None))
    return store, now


_STORE = f"""
horizon AS (SELECT max({t.TURN_MS}) AS now_ms FROM turns),
store AS (SELECT msgType AS post_type, post_id, text AS body, {t.TURN_MS} AS created_at_epoch_ms,
    CASE WHEN {t.TURN_MS} >= now_ms - 43200000
         THEN 1 + conv_id % 40 + CASE WHEN msgType = 'stocktwit' THEN 1 ELSE 3 END * turn * 3 ELSE 1 END AS impact,
    CAST(((post_id % 103) / 102.0) * CAST(0.8 AS DOUBLE) + ((post_id % 107) / 106.0) * CAST(0.2 AS DOUBLE)
         AS DECIMAL(5,2)) AS sentiment_mixed
  FROM wanted, horizon)"""


@query(
    "stream_ingest",
    f"""WITH {t.TURNS}, {_WANTED}, {_STORE}
SELECT post_type, post_id, body, created_at_epoch_ms, CAST(impact AS DOUBLE) AS impact,
       CAST(sentiment_mixed AS DOUBLE) AS sentiment_mixed FROM store""",
)
def stream_ingest(spark, sf_dir):
    """Posts table after filter, de-duplication, scoring, upsert and impact on a stream."""
    store, _ = _ingested(spark, sf_dir)
    return store.posts().select(
        "post_type", "post_id", "body", "created_at_epoch_ms",
        F.col("impact").cast("double").alias("impact"), F.col("sentiment_mixed").cast("double").alias("sentiment_mixed"),
    )


@query(
    "stream_indices",
    f"""WITH {t.TURNS}, {_WANTED}, {_STORE},
platform AS (SELECT k.kind AS sentiment_type,
    {_mean3("sum(CAST(impact * (sentiment_mixed - 0.5) * 10000 AS BIGINT))", "count(impact)", 1, 10)} AS mean
  FROM (VALUES ('stocktwits'), ('twitter')) k(kind) LEFT JOIN
    (SELECT *, CASE WHEN post_type = 'stocktwit' THEN 'stocktwits' ELSE 'twitter' END AS kind
     FROM store, horizon WHERE created_at_epoch_ms >= now_ms - 43200000) r USING (kind) GROUP BY k.kind),
both_rows AS (SELECT * FROM platform
  UNION ALL SELECT 'social_combined', {_mean3(f"sum(500 + {_thousandths('mean')})", "count(mean)", 50)} FROM platform)
SELECT sentiment_type, CAST(43200 AS BIGINT) AS sentiment_seconds_back, now_ms AS created_at_epoch_ms,
       CAST(mean AS DOUBLE) AS sentiment_absolute FROM both_rows, horizon""",
)
def stream_indices(spark, sf_dir):
    """Indices over posts as the last micro-batch left them."""
    store, now = _ingested(spark, sf_dir)
    rows = store.indices(now).filter(F.col("sentiment_type").isin("stocktwits", "twitter", "social_combined"))
    return rows.select(
        "sentiment_type", "sentiment_seconds_back", "created_at_epoch_ms",
        F.col("sentiment_absolute").cast("double").alias("sentiment_absolute"),
    )


@query(
    "stream_progress",
    f"WITH {t.TURNS}, {_WANTED}, k AS (SELECT DISTINCT post_id, post_id % 7 = 0 AS twice FROM wanted) "
    "SELECT count(*) + count(*) FILTER (twice) AS rows, count(*) + count(*) FILTER (twice) AS keyed FROM k",
)
def stream_progress(spark, sf_dir):
    """Counters of a filter stage, one row per batch."""
    events = readers.stream_events(spark, _landed_turns(spark, sf_dir), files_per_trigger=4)
    kept = stages.filter_stage(events, _WORDS).drop("data")
    counts = scratch_path(spark, "counts")
    stages.land_counted(kept, scratch_path(spark, "kept"), counts, scratch_path(spark, "state")).start().awaitTermination()
    return spark.read.parquet(counts).agg(F.sum("rows").alias("rows"), F.sum("keyed").alias("keyed"))


@query(
    "stream_changes",
    f"""WITH {t.POST_EVENTS},
v AS (SELECT *, row_number() OVER k AS rn, lag(interaction_total) OVER k AS pi, lag(likes_total) OVER k AS pl FROM p
      WINDOW k AS (PARTITION BY post_type, message_id ORDER BY ms, event_id))
SELECT event_id, post_type, message_id, interaction_total, likes_total, ms FROM v
WHERE rn = 1 OR interaction_total IS DISTINCT FROM pi OR likes_total IS DISTINCT FROM pl""",
)
def stream_changes(spark, sf_dir):
    """Versions that change a counter, by keyed state over a stream that brings them in three parts."""
    path, out = scratch_path(spark, "versions"), scratch_path(spark, "changes")
    versions = t.post_events(spark, sf_dir).select("event_id", "post_type", "message_id", "interaction_total", "likes_total", "ms")
    first, last = versions.agg(F.min("ms"), F.max("ms")).first()
    third = F.floor((F.col("ms") - first) * 3 / (last - first + 1))
    for part in range(3):
        versions.filter(third == part).coalesce(1).write.mode("append").parquet(path)
    session = changes.with_state_store(spark)
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # no timer is to fire here
    stream = session.readStream.schema(versions.schema).option("maxFilesPerTrigger", 1).parquet(path)
    changed = changes.changes(stream, ["ms", "event_id"], ["interaction_total", "likes_total"])
    _run(changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True))
    return spark.read.parquet(out).filter(F.col("reason") == changes.CHANGED).drop("reason")
