import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from moodgauge.operators import impact, indices

HOUR = 3_600_000
NOW = 1_536_584_735_000
POSTS = "post_type string, post_id bigint, created_at_epoch_ms bigint, impact decimal(10,2), sentiment_mixed decimal(5,2)"


def posts_of(spark, data):
    return spark.createDataFrame([(k, i, t, Decimal(str(w)), None if s is None else Decimal(str(s))) for k, i, t, w, s in data], POSTS)


def test_engagement_and_relevant(spark, rows):
    twits = spark.createDataFrame([(1, 1, 3), (1, 2, 2), (9, 9, 9)], "message_id bigint, conversation_replies bigint, likes_total bigint")
    users = spark.createDataFrame([(1, 5, 19), (1, 5, 19)], "tweet_id bigint, retweet_count bigint, favorite_count bigint")
    topics = spark.createDataFrame([(2, None, None)], users.schema)
    raw = impact.engagement(twits, users, topics)
    stored = posts_of(spark, [
        ("stocktwit", 1, NOW - 12 * HOUR, 1, 0.5), ("stocktwit", 9, NOW - 12 * HOUR - 1, 1, 0.5),
        ("twitter-user", 1, NOW, 1, 0.5), ("twitter-topic", 2, NOW, 1, 0.5), ("twitter-topic", 1, NOW, 1, 0.5),
    ])
    got = impact.with_impact(impact.relevant_engagement(raw, stored, NOW))
    assert rows(got) == [
        ("stocktwit", 1, 2, 3, Decimal("6.00")), ("twitter-topic", 2, None, None, Decimal("1.00")),
        ("twitter-user", 1, 5, 19, Decimal("35.00")),
    ]


def test_an_impact_too_large_to_store_fails_alone(spark, rows):
    raw = spark.createDataFrame([("stocktwit", 1, 10**12, 1), ("stocktwit", 2, 1, 1)],
                                "post_type string, message_id bigint, interaction_total bigint, likes_total bigint")
    assert rows(impact.with_impact(raw), "message_id", "impact") == [(1, None), (2, Decimal("3.00"))]


def test_changed_and_apply(spark, rows):
    shape = "post_type string, message_id bigint, interaction_total bigint, likes_total bigint"
    before = spark.createDataFrame([("a", 1, 1, 1), ("a", 2, None, 1), ("b", 1, 5, 5)], shape)
    now = spark.createDataFrame([("a", 1, 1, 1), ("a", 2, 0, 1), ("b", 1, 5, 6), ("c", 1, None, None)], shape)
    changed = impact.changed(now, before)
    assert rows(changed, "post_type", "message_id") == [("a", 2), ("b", 1), ("c", 1)]
    stored = posts_of(spark, [("a", 1, 0, 7, 0), ("b", 1, 0, 7, 0)])
    updates = changed.withColumn("impact", F.lit(12).cast("decimal(10,2)"))
    assert rows(impact.apply_impact(stored, updates), "post_type", "impact") == [("a", Decimal("7.00")), ("b", Decimal("12.00"))]


def test_platform_sentiment(spark, rows):
    data = [
        ("stocktwit", 1, NOW - 12 * HOUR, 10, 0.9), ("stocktwit", 2, NOW, 1, 0.1), ("stocktwit", 3, NOW, 5, None),
        ("stocktwit", 4, NOW - 12 * HOUR - 1, 1000, 0.9), ("other", 5, NOW, 1000, 0.9),
    ]
    got = indices.platform_sentiment(posts_of(spark, data), NOW)
    assert rows(got, "sentiment_type", "sentiment_seconds_back", "created_at_epoch_ms", "sentiment_absolute") == [
        ("stocktwits", 43200, NOW, Decimal("1.800")), ("twitter", 43200, NOW, None),
    ]


INDEX = "sentiment_type string, sentiment_seconds_back bigint, created_at_epoch_ms bigint, sentiment_absolute decimal(10,3), sentiment_normalized decimal(5,3)"


def index_of(spark, data):
    return spark.createDataFrame([(k, s, t, None if v is None else Decimal(str(v)), None) for k, s, t, v in data], INDEX)


def test_combined_index(spark, rows):
    data = [
        ("twitter", 3600, NOW - HOUR, 0.5), ("stocktwits", 3600, NOW, 1.5), ("twitter", 3600, NOW - HOUR - 1, 99),
        ("twitter", 7200, NOW - HOUR - 1, 2), ("news_external_ensemble", 3600, NOW, 50),
    ]
    got = indices.combined_index(index_of(spark, data), NOW, "both")
    assert rows(got, "sentiment_type", "sentiment_seconds_back", "sentiment_absolute") == [
        ("both", 3600, Decimal("75.000")), ("both", 7200, Decimal("125.000")),
    ]
    assert indices.combined_index(index_of(spark, []), NOW).count() == 0


def feeds_of(spark, percent, score, news=(), buzz=()):
    def feed(data, name):
        return spark.createDataFrame(list(data), f"client_received_ts_ms bigint, {name} double")

    return {
        "sentiment_percent": feed(percent, "sentiment_percent"), "sentiment_score": feed(score, "sentiment_score"),
        "news_score": feed(news, "news_sentiment_score"), "buzz": feed(buzz, "current_buzz"),
    }


def test_ensembles_count_equal_pairs_once(spark):
    feeds = feeds_of(spark, [(NOW, 10.0), (NOW, 10.0), (NOW - 1, 10.0)], [(NOW, 20.0), (NOW, 80.0), (NOW - 13 * HOUR, 2.0)])
    got = indices.social_ensemble(feeds["sentiment_percent"], feeds["sentiment_score"], NOW).first()
    assert got.sentiment_absolute == Decimal("20.000") and got.sentiment_type == "social_external_ensemble"
    assert indices.news_ensemble(feeds["news_score"], feeds["buzz"], NOW).first().sentiment_absolute is None


def test_publish_all_sees_its_own_rows(spark, rows):
    posts = posts_of(spark, [("stocktwit", 1, NOW, 10, 0.9), ("twitter-user", 1, NOW, 4, 0.25)])
    feeds = feeds_of(spark, [(NOW, 10.0)], [(NOW, 60.0)], [(NOW, 3.0)], [(NOW, 5.0)])
    got = indices.publish_all(posts, index_of(spark, []), feeds, NOW)
    values = {r.sentiment_type: float(r.sentiment_absolute) for r in got.collect()}
    assert values == {
        "stocktwits": 4.0, "twitter": -1.0, "social_combined": 100.0, "social_external_ensemble": 20.0,
        "news_external_ensemble": 4.0, "global_external_ensemble": 12.0,
    }


def test_trailing_sentiment_against_brute_force(spark):
    rng = random.Random(1)
    span = 40 * HOUR
    data = [
        (rng.choice(["stocktwit", "twitter-user", "twitter-topic", "other"]), n,
         NOW + (rng.randrange(span) if n % 3 else 5 * HOUR + rng.randrange(3)), rng.randint(1, 300), rng.randint(0, 100) / 100)
        for n in range(900)
    ]
    data += [("stocktwit", 1000, NOW + 50 * HOUR, 7, 0.6), ("stocktwit", 1001, NOW + 62 * HOUR, 9, 0.1),
             ("stocktwit", 1002, NOW + 74 * HOUR + 1, 9, None)]
    got = {
        (r.platform, r.created_at_epoch_ms): (r.n_posts, r.sentiment_absolute)
        for r in indices.trailing_sentiment(posts_of(spark, data)).collect()
    }
    names = {k: name for name, kinds in indices.PLATFORMS.items() for k in kinds}
    want = {}
    for name in indices.PLATFORMS:
        mine = [r for r in data if names.get(r[0]) == name]
        for moment in {r[2] for r in mine}:
            inside = [r for r in mine if moment - 12 * HOUR <= r[2] <= moment]
            rated = [Decimal(str(w)) * (Decimal(str(s)) - Decimal("0.5")) for *_, w, s in inside if s is not None]
            mean = None
            if rated:
                mean = (sum(rated) / len(rated)).quantize(Decimal("0.001"), "ROUND_HALF_UP")
            want[name, moment] = (len(inside), mean)
    assert got == want


def test_changed_versions_with_a_hot_post(spark):
    rng = random.Random(2)
    data = [("a" if n % 2 else "b", 1 if n % 3 else n, n, rng.choice([1, 1, 2, None])) for n in range(600)]
    frame = spark.createDataFrame(data, "post_type string, message_id bigint, ms bigint, likes int")
    got = {r.ms for r in impact.changed_versions(frame, ["ms"], ["likes"], F.call_function("div", F.col("ms"), F.lit(50))).collect()}
    last, want = {}, set()
    for kind, post, ms, likes in data:
        if (kind, post) not in last or last[kind, post] != likes:
            want.add(ms)
        last[kind, post] = likes
    assert got == want


def test_backfill(spark, rows):
    day = 24 * HOUR
    frame = index_of(spark, [("x", 1, NOW - 60 * day, 0), ("x", 1, NOW - 60 * day - 1, 0)])
    got = indices.backfill_seconds_back(frame, NOW)
    assert rows(got, "sentiment_seconds_back") == [(1,), (10800000,)]


@pytest.mark.parametrize("function", [indices.platform_sentiment])
def test_platforms_share_one_scan(spark, tmp_path, function):
    posts_of(spark, [("stocktwit", 1, NOW, 1, 0.5)]).write.parquet(str(tmp_path / "p"))
    plan = function(spark.read.parquet(str(tmp_path / "p")), NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(created_at_epoch_ms" in plan
