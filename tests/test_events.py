import json
import os

import pytest
from pyspark.sql import functions as F

from moodgauge import schemas
from moodgauge.operators import filters, posts
from moodgauge.sources import readers, writers
from moodgauge.streaming import stages


def tweet(post_id, kind, text, created="Mon Sep 10 13:05:35 +0000 2018", received=1000, **more):
    data = {"id": post_id, "text": text, "created_at": created, "source": "<a>web</a>",
            "user": {"id": 1, "screen_name": "ann"}, **more}
    return {"schema": "posts-common", "msgType": kind, "clientReceivedTsMs": received, "data": data}


def stocktwit(post_id, body, created="2018-08-10T17:17:53Z", received=1000, **more):
    data = {"id": post_id, "body": body, "created_at": created, "source": {"id": 5, "title": "web"},
            "user": {"id": 2, "username": "bob"}, **more}
    return {"schema": "posts-common", "msgType": "stocktwit", "clientReceivedTsMs": received, "data": data}


def write_lines(path, records, extra=()):
    path.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(r) for r in records] + list(extra)
    number = len(list(path.iterdir()))
    file = path / f"part-{number}.json"
    file.write_text("\n".join(lines) + "\n")
    # files arrive a minute apart, in this order
    os.utime(file, (1_500_000_000 + 60 * number,) * 2)
    return str(path)


EVENTS = [
    tweet(1, "twitter-user", "My Model 3 arrived"),
    tweet(1, "twitter-topic", "My Model 3 arrived", received=2000),
    tweet(2, "twitter-topic", "RT @x: tesla up"),
    tweet(3, "twitter-topic", "nothing of note"),
    tweet(4, "twitter-user", "so rt tesla later"),
    tweet(5, "twitter-list", "tesla"),
    tweet(6, "twitter-user", "model3 without the space"),
    tweet(7, "twitter-user", "long $TSLAQ thread"),
    stocktwit(1, "rt no keyword needed here"),
    stocktwit(8, "calls"),
    {"msgType": "stocktwit", "data": {"body": "no id"}},
    {"msgType": "twitter-user", "data": {"id": 9}},
]


@pytest.fixture
def events(spark, tmp_path):
    return readers.read_events(spark, write_lines(tmp_path / "in", EVENTS, ['{"msgType": "stocktwit", "da', "", "   "]))


def test_bad_lines_are_set_aside(events):
    assert [r.value for r in readers.bad_records(events).collect()] == ['{"msgType": "stocktwit", "da']
    assert readers.good_events(events).count() == len(EVENTS)


def test_source_is_read_as_text_on_both_platforms(events, rows):
    got = {r[0] and r[0].replace(" ", "") for r in rows(events.select("data.source"))}
    assert got == {"<a>web</a>", '{"id":5,"title":"web"}', None}


def test_filter_stage(events, rows):
    kept = stages.filter_stage(events)
    assert rows(kept, "msgType", "platform", "id") == [
        ("stocktwit", "stocktwit", 1), ("stocktwit", "stocktwit", 8),
        ("twitter-topic", "twitter", 1), ("twitter-user", "twitter", 1),
        ("twitter-user", "twitter", 4), ("twitter-user", "twitter", 7),
    ]


def test_first_seen_and_unseen(spark, events, rows):
    first = filters.first_seen(stages.filter_stage(events), ["clientReceivedTsMs"])
    assert rows(first, "platform", "id", "msgType") == [
        ("stocktwit", 1, "stocktwit"), ("stocktwit", 8, "stocktwit"), ("twitter", 1, "twitter-user"),
        ("twitter", 4, "twitter-user"), ("twitter", 7, "twitter-user"),
    ]
    stored = spark.createDataFrame([("twitter-topic", 4), ("stocktwit", 8), ("stocktwit", 7)], "post_type string, post_id bigint")
    assert rows(filters.unseen(first, stored), "platform", "id") == [("stocktwit", 1), ("twitter", 1), ("twitter", 7)]


def test_to_request(events, rows):
    requests = posts.to_request(readers.good_events(events).filter("data.id in (7, 8)"))
    assert rows(requests, "msgType", "data.id", "data.text") == [
        ("stocktwit-sentiment-request", 8, "calls"),
        ("twitter-user-sentiment-request", 7, "long $TSLAQ thread"),
    ]
    assert "body" not in requests.schema["data"].dataType.fieldNames()


def scored(spark, kind, post_id, user, created, bull=0.125):
    values = {"bear_sentiment": 1 - bull, "bull_sentiment": bull, "vader_sentiment": 0.5, "bull_vader_sentiment": 0.7}
    event = {"msgType": kind, "clientReceivedTsMs": 5, "predictions": {"values": values},
             "data": {"id": post_id, "text": "t", "created_at": created, "user": user}}
    frame = spark.createDataFrame([(json.dumps(event),)], "value string")
    return readers.good_events(readers.parse_records(frame))


def test_flatten(spark):
    twit = scored(spark, "stocktwit-sentiment-response", 2**60 + 1, {"username": "bob"}, "2018-08-10T17:17:53Z")
    row = posts.flatten(twit).first()
    assert row.post_id == 2**60 + 1 and row.created_at_epoch_ms == 1533921473000
    assert row.link == f"https://stocktwits.com/bob/message/{2**60 + 1}" and row.user_name == "bob"
    assert str(row.sentiment_ml_model) == "0.13" and str(row.impact) == "1.00"
    shape = [(f.name, f.dataType) for f in posts.flatten(twit).schema]
    assert shape == [(f.name, f.dataType) for f in schemas.POSTS]
    tw = posts.flatten(scored(spark, "twitter-topic-sentiment-response", 7, {"screen_name": "ann"}, "Mon Sep 10 13:05:35 +0000 2018"))
    assert tw.first().link == "https://twitter.com/ann/status/7" and tw.first().post_type == "twitter-topic"
    assert posts.flatten(scored(spark, "other-sentiment-response", 7, {}, "")).count() == 0


def test_storable(spark):
    row = posts.flatten(scored(spark, "stocktwit-sentiment-response", 3, {"username": "bob"}, "garbage"))
    good, bad = filters.split_bad_rows(row, posts.storable(row))
    assert good.count() == 0 and bad.count() == 1


def test_wrap_event(spark):
    frame = spark.range(1).select(
        posts.wrap_event(F.struct(F.lit(1).alias("id")), "feed", "kind", received=F.lit(9)).alias("e"),
        posts.wrap_event(F.struct(F.lit(1).alias("id")), "feed", "kind", "other").alias("o"),
    )
    event = frame.first()
    assert event.e.dataSource == "feed" and event.e.clientReceivedTsMs == 9 and event.e.entityId == 1
    assert event.o.dataSource == "other" and event.o.clientReceivedTsMs > 1_500_000_000_000


def test_latest_version(spark):
    data = [("a", 1, 1, "x"), ("a", 1, 3, "z"), ("a", 1, 2, "y"), ("b", 1, 1, None)]
    frame = spark.createDataFrame(data, "post_type string, post_id bigint, n int, body string")
    assert {tuple(r) for r in posts.latest_version(frame, ["n"]).collect()} == {("a", 1, 3, "z"), ("b", 1, 1, None)}


def test_canonical_lines_and_keys(spark, rows):
    raw = [('{"msgType": "x",  "data": {"id": 1}}',), ("\n",), ("",), ("{broken",), (None,)]
    frame = spark.createDataFrame(raw, "value string")
    assert rows(readers.canonical_lines(frame)) == [('{"msgType":"x","data":{"id":1}}',)]
    long = "a" * 73 + "b" * 127 + "c"
    same = spark.createDataFrame([(long,), ("x" * 73 + "b" * 127 + "zzz",), (" \n",)], "value string")
    keyed = writers.keyed_records(same).collect()
    assert len(keyed) == 2 and len({r.key for r in keyed}) == 1


@pytest.mark.parametrize(
    "position, value, want",
    [
        ("TRIM_HORIZON", None, [1, 2, 3]), ("AT_SEQUENCE_NUMBER", 2, [2, 3]), ("AFTER_SEQUENCE_NUMBER", 2, [3]),
        ("AT_TIMESTAMP", 200, [2, 3]), ("LATEST", None, []), ("LATEST", 2, [3]),
    ],
)
def test_replay_from(spark, position, value, want):
    frame = spark.createDataFrame([(1, 100), (2, 200), (3, 300)], "seq bigint, ts bigint")
    assert sorted(r.seq for r in readers.replay_from(frame, position, value).collect()) == want


def test_replay_from_unknown_position(spark):
    with pytest.raises(ValueError):
        readers.replay_from(spark.range(1), "SOMEWHERE")


def test_highest_positions(spark, rows):
    frame = spark.createDataFrame([(0, 5, 1), (0, 5, 2), (0, 4, 9), (1, 1, 0)], "shard int, seq bigint, sub_seq bigint")
    assert rows(stages.highest_positions(frame)) == [(0, 5, 2), (1, 1, 0)]


def test_labelled_csv_round_trip(spark, tmp_path, rows):
    data = [(0, 'quote " and, comma'), (1, "two\nlines"), (1, " padded "), (0, "back\\slash")]
    frame = spark.createDataFrame(data, "labels int, text string")
    writers.write_labelled_csv(frame, str(tmp_path / "csv"))
    assert rows(readers.read_labelled_csv(spark, str(tmp_path / "csv"))) == sorted(data, key=lambda r: tuple((False, str(v)) for v in r))


def test_json_lines_drop_duplicates(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id bigint, name string")
    path = tmp_path / "out"
    writers.write_json_lines(frame, str(path))
    assert any(f.name.endswith(".json.gz") for f in path.iterdir())
    assert readers.read_json_lines(spark, str(path), "id bigint, name string").count() == 2


def test_class_names_and_prefixed_text(spark, tmp_path, rows):
    writers.write_class_names(spark, str(tmp_path / "classes"))
    assert {r.value for r in spark.read.text(str(tmp_path / "classes")).collect()} == {"Bearish", "Bullish"}
    (tmp_path / "train.txt").write_text("__label__1 bad\n__label__2 good\n__label__2 fine\n")
    got = readers.read_label_prefixed(spark, str(tmp_path / "train.txt"))
    assert rows(got) == [(0, " bad"), (1, " fine"), (1, " good")]


def test_accounts_keep_large_ids(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1039137814951157761, "name": "n", "screen_name": "s"}\n')
    assert readers.read_accounts(spark, str(tmp_path / "a.json")).first().id == 1039137814951157761


def test_query_store(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert readers.query_store(spark, "select count(*) as n from numbers").first().n == 3
