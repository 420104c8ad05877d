"""Stages of the live flow as Structured Streaming queries."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from moodgauge.functions.moments import LOOK_BACK_SECONDS, epoch_ms
from moodgauge.operators import filters, impact, indices, posts
from moodgauge.sources.readers import good_events
from moodgauge.sources.store import PostStore


def deduplicate(events: DataFrame, keys=("platform", "id"), event_time: str | None = None,
                delay: str = "12 hours") -> DataFrame:
    """First arrival per key on a stream.

    Without `event_time` all keys are remembered, so nothing is ever let through twice or dropped as
    late. With it, keys are forgotten `delay` after their event, which bounds the state; repeats
    beyond that are the durable check's, and rows later than the watermark are dropped.
    """
    if event_time is None:
        return events.dropDuplicates(list(keys))
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def filter_stage(events: DataFrame, keywords=filters.KEYWORDS) -> DataFrame:
    """Events to keyed posts worth scoring, in batch and stream alike."""
    body = F.coalesce(F.col("data.text"), F.col("data.body"))
    wanted = filters.wanted_posts(good_events(events).withColumn("_text", body), "msgType", "_text", keywords)
    return filters.add_key(wanted, "msgType", "data.id").drop("_text").filter(F.col("id").isNotNull())


def request_stage(keyed: DataFrame) -> DataFrame:
    return posts.to_request(keyed.drop("platform", "id"))


def sliding_sentiment(events: DataFrame, event_time: str, slide: str = "30 seconds", length: str = "12 hours",
                      delay: str = "12 hours") -> DataFrame:
    """Platform sentiment per sliding window of a stream of posts; late posts count until `delay`."""
    rated = events.withColumn("sentiment_type", indices.platform_of(F.col("post_type")))
    return (
        rated.filter(F.col("sentiment_type").isNotNull())
        .withWatermark(event_time, delay)
        .groupBy(F.window(event_time, length, slide), "sentiment_type")
        .agg(F.avg(indices.weighted_sentiment()).alias("sentiment_absolute"))
    )


def highest_positions(records: DataFrame) -> DataFrame:
    """Furthest (seq, sub_seq) per shard."""
    top = F.max(F.struct("seq", "sub_seq"))
    return records.groupBy("shard").agg(top.alias("t")).select("shard", "t.seq", "t.sub_seq")


def land_counted(events: DataFrame, path: str, counts: str, checkpoint: str) -> DataStreamWriter:
    """Write each batch, and beside it a row of its counters, observed while it is written.

    Progress reports keep the last batches only; the rows below `counts` are one per batch, and a batch that runs again
    replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation("counters")
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("id").alias("keyed"))
        counted.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")
        row = batch.sparkSession.createDataFrame([(seen.get["rows"], seen.get["keyed"])], "rows bigint, keyed bigint")
        row.write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


#: Indices are published again after this time, even if no impact changed.
RECOMPUTE_MS = 30_000


class Ingest:
    """One micro-batch from raw events to published indices.

    `score` maps request events with a unique `request_id` to scored events. `engagement(from_ms)` gives
    the raw counters and `feeds(from_ms)` the external feeds received since then: nothing older can
    belong to the look-back, so a batch never reads the whole history. A batch that runs again after a failure writes
    the same folders again and reads only earlier batches, so its result is the same.
    """

    def __init__(self, store: PostStore, score, engagement, feeds, now=None, keywords=filters.KEYWORDS,
                 recompute_ms: int = RECOMPUTE_MS):
        self.store, self.score, self.engagement, self.feeds = store, score, engagement, feeds
        self.now, self.keywords, self.recompute_ms = now, keywords, recompute_ms

    def _now_ms(self) -> int:
        if self.now is not None:
            return self.now() if callable(self.now) else int(self.now)
        return self.store.spark.range(1).select(F.unix_millis(F.current_timestamp())).first()[0]

    def new_posts(self, events: DataFrame, batch_id: int) -> DataFrame:
        keyed = filter_stage(events, self.keywords)
        # equal times and types: the content decides, so that a batch that runs again stores the same body
        content = keyed.withColumn("_content", F.sha2(F.to_json("data"), 256))
        first = filters.first_seen(content, ["clientReceivedTsMs", "msgType", "_content"]).drop("_content")
        created = epoch_ms(F.col("data.created_at"))
        earliest, latest = keyed.agg(F.min(created)).scalar(), keyed.agg(F.max(created)).scalar()
        return filters.unseen(first, self.store.post_keys(batch_id, earliest, latest))

    def requests(self, events: DataFrame, batch_id: int) -> DataFrame:
        """New posts of a batch as scoring requests with a unique `request_id`."""
        fresh = self.new_posts(events, batch_id)
        keyed = fresh.withColumn("request_id", F.concat_ws(":", "platform", "id"))
        return posts.to_request(keyed.drop("platform", "id"))

    def _due(self, batch_id: int, now: int) -> bool:
        """Whether the last earlier batch that published did so long enough ago."""
        last = self.store.indices(now - self.recompute_ms, batch_id).agg(F.max("created_at_epoch_ms")).first()[0]
        return last is None or now - last > self.recompute_ms

    def refresh(self, batch_id: int, now: int) -> None:
        """Impact of changed posts, then all indices of one moment.

        Indices are published when an impact changed or when they are older than `recompute_ms`.
        """
        start = now - LOOK_BACK_SECONDS * 1000
        recent = self.store.posts(start, batch_id + 1)
        relevant = impact.with_impact(impact.relevant_engagement(self.engagement(start), recent, now))
        storable = relevant.filter(F.col("impact").isNotNull())
        changed = impact.changed(storable, self.store.impacts(start, batch_id))
        stamps = recent.select("post_type", F.col("post_id").alias("message_id"), "created_at_epoch_ms")
        self.store.append_impacts(changed.join(stamps, impact.KEY), batch_id)
        if self.store.impacts_of(batch_id).isEmpty() and not self._due(batch_id, now):
            return
        # a moment published before is replaced, not averaged in
        published = self.store.indices(start, batch_id).filter(F.col("created_at_epoch_ms") < now)
        rows = indices.publish_all(self.store.posts(start, batch_id + 1), published, self.feeds(start), now)
        self.store.append_indices(rows, batch_id)

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        # classifier and lexicon both read the requests
        requests = self.requests(events, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = posts.flatten(self.score(requests))
            self.store.append_posts(rows.filter(posts.storable(rows)), batch_id)
        finally:
            requests.unpersist()
        self.refresh(batch_id, self._now_ms())

    def writer(self, events: DataFrame, checkpoint: str, every: str | None = "30 seconds") -> DataStreamWriter:
        """The streaming query; `every=None` works off what is there and stops."""
        query = events.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return query.trigger(processingTime=every) if every else query.trigger(availableNow=True)


def land(events: DataFrame, path: str, checkpoint: str, every: str | None = None) -> DataStreamWriter:
    """Append events of a stream to JSON-lines files; files and checkpoint advance together."""
    query = events.writeStream.format("json").outputMode("append")
    query = query.option("path", path).option("checkpointLocation", checkpoint)
    return query.trigger(processingTime=every) if every else query.trigger(availableNow=True)


def add_event_time(events: DataFrame, name: str = "created_at") -> DataFrame:
    """Event time of a post as a timestamp, for watermarks and windows."""
    return events.withColumn(name, F.timestamp_millis(epoch_ms(F.col("data.created_at"))))
