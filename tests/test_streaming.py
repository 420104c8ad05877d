import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from moodgauge.functions import text
from moodgauge.operators import indices, models, posts, scoring
from moodgauge.sources import readers
from moodgauge.sources.store import PostStore
from moodgauge.streaming import stages

from test_events import stocktwit, tweet, write_lines

NOW = 1_536_584_735_000
HOUR = 3_600_000
EMPTY_FEEDS = {
    "sentiment_percent": "sentiment_percent", "sentiment_score": "sentiment_score",
    "news_score": "news_sentiment_score", "buzz": "current_buzz",
}


def score(requests):
    values = F.struct(
        F.lit(0.25).alias("bear_sentiment"), F.lit(0.75).alias("bull_sentiment"),
        F.lit(0.5).alias("vader_sentiment"), F.lit(0.7).alias("bull_vader_sentiment"),
    )
    scored = requests.withColumn("predictions", F.struct(values.alias("values")))
    return scored.withColumn("msgType", posts.response_type(F.col("msgType")))


def at(ms):
    """Worded date of an hour-grid moment."""
    import datetime

    moment = datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc)
    return moment.strftime("%a %b %d %H:%M:%S +0000 %Y")


def ingest_of(spark, store, counters=None, now=NOW):
    shape = "post_type string, message_id bigint, interaction_total bigint, likes_total bigint"

    def engagement(from_ms):
        return spark.createDataFrame(counters if counters is not None else [("twitter-user", 1, 5, 19)], shape)

    def feeds(from_ms):
        return {k: spark.createDataFrame([(NOW, 40.0)], f"client_received_ts_ms bigint, {v} double") for k, v in EMPTY_FEEDS.items()}

    return stages.Ingest(store, score, engagement, feeds, now)


def run(ingest, spark, folder, state):
    events = readers.stream_events(spark, folder, files_per_trigger=1)
    ingest.writer(events, state, every=None).start().awaitTermination()


BATCHES = [
    [tweet(1, "twitter-user", "tesla", at(NOW)), tweet(1, "twitter-topic", "tesla", at(NOW), received=2000),
     stocktwit(1, "up"), stocktwit(1, "up again", received=3000), stocktwit(2, "bad date", "whenever")],
    [tweet(1, "twitter-topic", "tesla", at(NOW)), tweet(3, "twitter-user", "tsla old", at(NOW - 13 * HOUR)),
     stocktwit(4, "late but in the window", "2018-08-10T17:17:53Z")],
    [tweet(5, "twitter-topic", "nothing"), {"msgType": "stocktwit"}],
]


def test_ingest(spark, tmp_path, rows):
    folder = tmp_path / "in"
    for batch in BATCHES:
        write_lines(folder, batch, ["{broken", ""])
    store = PostStore(spark, str(tmp_path / "store"))
    run(ingest_of(spark, store), spark, str(folder), str(tmp_path / "state"))
    assert rows(store.posts(), "post_type", "post_id", "body", "impact") == [
        ("stocktwit", 1, "up", Decimal("1.00")), ("stocktwit", 4, "late but in the window", Decimal("1.00")),
        ("twitter-user", 1, "tesla", Decimal("35.00")), ("twitter-user", 3, "tsla old", Decimal("1.00")),
    ]
    values = {r.sentiment_type: r.sentiment_absolute for r in store.indices().collect()}
    assert values["twitter"] == Decimal("7.000") and values["stocktwits"] is None
    assert values["social_combined"] == Decimal("375.000") and values["global_external_ensemble"] == Decimal("35.000")

    # a second run over the same checkpoint and no new files changes nothing
    before = rows(store.posts())
    run(ingest_of(spark, store), spark, str(folder), str(tmp_path / "state"))
    assert rows(store.posts()) == before
    # the whole input again, as after a lost checkpoint: the store itself keeps repeats out
    run(ingest_of(spark, store), spark, str(folder), str(tmp_path / "other-state"))
    assert rows(store.posts()) == before


def test_ingest_with_classifier_and_lexicon(spark, tmp_path, rows):
    corpus = [(f"{'love profit' if n % 2 else 'crash fraud'} w{n % 3}", n % 2) for n in range(60)]
    labelled = spark.createDataFrame(corpus, "text string, labels int").withColumn("text", text.model_input(F.col("text")))
    model = models.train(labelled, iterations=5)
    lexicon = spark.createDataFrame([("love", 3.2), ("fraud", -2.8)], "token string, valence double")
    store = PostStore(spark, str(tmp_path / "store"))
    ingest = ingest_of(spark, store)
    ingest.score = lambda requests: scoring.score_requests(requests, {"stocktwits": model, "twitter": model}, lexicon)
    batch = [tweet(1, "twitter-user", "tesla love profit", at(NOW)), stocktwit(2, "crash fraud"),
             tweet(1, "twitter-topic", "tesla love profit", at(NOW), received=5000)]
    folder = write_lines(tmp_path / "in", batch)
    run(ingest, spark, folder, str(tmp_path / "state"))
    bull = {r.post_id: (r.sentiment_ml_model, r.sentiment_vader_normalized, r.sentiment_mixed) for r in store.posts().collect()}
    assert set(bull) == {1, 2} and bull[1][0] > Decimal("0.5") > bull[2][0]
    assert bull[1][1] == Decimal("0.82") and bull[2][1] < Decimal("0.5")
    assert abs(bull[1][2] - (bull[1][0] * 4 + bull[1][1]) / 5) <= Decimal("0.01")


def test_a_repeated_batch_overwrites_itself(spark, tmp_path, rows):
    store = PostStore(spark, str(tmp_path / "store"))
    ingest = ingest_of(spark, store)
    first = readers.read_events(spark, write_lines(tmp_path / "a", BATCHES[0]))
    second = readers.read_events(spark, write_lines(tmp_path / "b", BATCHES[1]))
    ingest(first, 0)
    ingest(second, 1)
    posts_before, indices_before = rows(store.posts()), rows(store.indices())
    ingest(second, 1)
    assert rows(store.posts()) == posts_before and rows(store.indices()) == indices_before


def test_only_changed_impacts_are_written(spark, tmp_path, rows):
    store = PostStore(spark, str(tmp_path / "store"))
    events = [tweet(n, "twitter-user", "tesla", at(NOW)) for n in (1, 2)]
    first = readers.read_events(spark, write_lines(tmp_path / "a", events))
    nothing = first.limit(0)
    ingest_of(spark, store, [("twitter-user", 1, 0, 1), ("twitter-user", 2, 0, 1)])(first, 0)
    ingest_of(spark, store, [("twitter-user", 1, 0, 1), ("twitter-user", 2, 4, 1)], NOW + 1000)(nothing, 1)
    written = spark.read.parquet(str(tmp_path / "store" / "impacts"))
    assert rows(written, "batch_id", "message_id") == [(0, 1), (0, 2), (1, 2)]
    assert rows(store.posts(), "post_id", "impact") == [(1, Decimal("2.00")), (2, Decimal("14.00"))]
    # each moment publishes its own rows, and the combined index averages both
    combined = [r.sentiment_absolute for r in store.indices().filter("sentiment_type = 'social_combined'").orderBy("created_at_epoch_ms").collect()]
    assert combined == [Decimal("45.000"), Decimal("75.000")]


def test_indices_wait_while_nothing_changes(spark, tmp_path):
    store = PostStore(spark, str(tmp_path / "store"))
    first = readers.read_events(spark, write_lines(tmp_path / "a", [tweet(1, "twitter-user", "tesla", at(NOW))]))
    nothing = first.limit(0)
    for batch, (events, now) in enumerate([(first, NOW), (nothing, NOW + 30_000), (nothing, NOW + 30_001)]):
        ingest_of(spark, store, now=now)(events, batch)
    moments = {r[0] for r in store.indices().select("created_at_epoch_ms").collect()}
    assert moments == {NOW, NOW + 30_001}


def test_an_upsert_replaces_and_keeps_impact(spark, tmp_path, rows):
    store = PostStore(spark, str(tmp_path / "store"))
    shape = "post_type string, post_id bigint, body string, created_at_epoch_ms bigint"
    for batch, body in enumerate(["old", "new"]):
        frame = spark.createDataFrame([("stocktwit", 1, body, NOW)], shape)
        frame = frame.select("*", F.lit(1).cast("decimal(10,2)").alias("impact"))
        store.append_posts(frame, batch)
        if batch == 0:
            impact = spark.createDataFrame([("stocktwit", 1, 2, 3, Decimal("6.00"), NOW)],
                                           "post_type string, message_id bigint, interaction_total bigint, likes_total bigint, impact decimal(10,2), created_at_epoch_ms bigint")
            store.append_impacts(impact, batch)
    assert rows(store.posts(), "body", "impact") == [("new", Decimal("6.00"))]
    assert rows(store.posts(before_batch=1), "body") == [("old",)]
    packed = store.compact(str(tmp_path / "compact"), 1)
    assert rows(packed.posts()) == rows(store.posts())


def test_the_store_opens_only_the_days_it_needs(spark, tmp_path):
    store = PostStore(spark, str(tmp_path / "store"))
    shape = "post_type string, post_id bigint, created_at_epoch_ms bigint"
    data = [("stocktwit", n, NOW - n * 24 * HOUR) for n in range(10)]
    store.append_posts(spark.createDataFrame(data, shape).withColumn("impact", F.lit(1).cast("decimal(10,2)")), 0)
    plan = store.post_keys(from_ms=NOW - 30 * HOUR)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(created_at_epoch_ms" in plan
    assert store.post_keys(from_ms=NOW - 30 * HOUR).count() == 2
    assert store.post_keys(from_ms=NOW - 60 * HOUR, to_ms=NOW - 30 * HOUR).count() == 1


def test_empty_store(spark, tmp_path):
    store = PostStore(spark, str(tmp_path / "none"))
    assert store.posts().count() == 0 and store.indices(NOW).count() == 0


@pytest.mark.parametrize("timed", [False, True])
def test_stream_deduplicate(spark, tmp_path, timed, rows):
    folder = tmp_path / "in"
    for name, ids in enumerate([[1, 2, 2], [2, 3, 1]]):
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text("\n".join(json.dumps({"platform": "x", "id": i, "t": "2018-09-10T13:00:00Z"}) for i in ids))
    stream = spark.readStream.schema("platform string, id bigint, t timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    unique = stages.deduplicate(stream, event_time="t" if timed else None)
    stages.land(unique, str(tmp_path / "out"), str(tmp_path / "state")).start().awaitTermination()
    got = spark.read.schema("platform string, id bigint").json(str(tmp_path / "out"))
    assert rows(got, "id") == [(1,), (2,), (3,)]


def test_filter_and_request_stage_stream_equals_batch(spark, tmp_path, rows):
    folder = write_lines(tmp_path / "in", BATCHES[0] + BATCHES[1], ["{x"])
    stream = stages.request_stage(stages.filter_stage(readers.stream_events(spark, folder)))
    stages.land(stream, str(tmp_path / "out"), str(tmp_path / "state")).start().awaitTermination()
    batch = stages.request_stage(stages.filter_stage(readers.read_events(spark, folder)))
    landed = readers.read_events(spark, str(tmp_path / "out"))
    columns = ["msgType", "data.id", "data.text", "clientReceivedTsMs"]
    assert rows(landed.select(*columns)) == rows(batch.select(*columns))


def test_event_time_column(spark):
    events = spark.createDataFrame([("Mon Sep 10 13:05:35 +0000 2018",)], "c string").select(F.struct(F.col("c").alias("created_at")).alias("data"))
    got = stages.add_event_time(events).select(F.unix_millis("created_at")).first()[0]
    assert got == 1536584735000


def test_sliding_windows_equal_the_batch_mean(spark, tmp_path):
    shape = "post_type string, impact decimal(10,2), sentiment_mixed decimal(5,2), created_at timestamp"
    data = [("stocktwit", Decimal(n), Decimal("0.90"), n * 3600) for n in range(1, 30)]
    frame = spark.createDataFrame(data, shape.replace("timestamp", "bigint")).withColumn("created_at", F.timestamp_seconds("created_at"))
    frame.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    windows = stages.sliding_sentiment(stream, "created_at", "6 hours")
    out = str(tmp_path / "out")
    (windows.writeStream.outputMode("complete").trigger(availableNow=True)
     .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(out))
     .option("checkpointLocation", str(tmp_path / "state")).start().awaitTermination())
    got = {r.s: float(r.sentiment_absolute) for r in spark.read.parquet(out).select(F.unix_seconds("window.start").alias("s"), "sentiment_absolute").collect()}
    for start in range(-6, 30, 6):
        inside = [float(n) * 0.4 for n in range(1, 30) if start <= n < start + 12]
        if inside:
            assert got[start * 3600] == pytest.approx(sum(inside) / len(inside))
    assert "sentiment_type" in windows.columns and indices.PLATFORMS
