"""Change detection as stream state, and scoring in place, against their batch forms."""

import time

import pytest
from pyspark.sql import functions as F

from moodgauge.operators import lexicon, models, scoring
from moodgauge.streaming import changes

SCHEMA = "event_id long, post_type string, message_id long, interaction_total long, likes_total long, ms long"
VALUES = ["interaction_total", "likes_total"]


def test_changes_and_timers(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    session = changes.with_state_store(spark)
    parts = [
        [(1, "a", 1, 5, None, 10), (2, "a", 1, 5, None, 20), (3, "a", 2, 0, 0, 10)],
        [(4, "a", 1, 5, 1, 30), (6, "a", 2, 0, 0, 40), (5, "a", 2, 1, 0, 35)],
    ]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    found = changes.changes(stream, ["ms", "event_id"], VALUES, recompute_ms=500)
    run = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).start()
    until = time.time() + 60
    rows = []
    while time.time() < until and not any(r.reason == changes.DUE for r in rows):
        time.sleep(2)
        rows = spark.read.schema(f"{SCHEMA}, reason string").parquet(out).collect()
    run.stop()
    assert sorted(r.event_id for r in rows if r.reason == changes.CHANGED) == [1, 3, 4, 5, 6]
    due = {r.event_id for r in rows if r.reason == changes.DUE}
    assert due and due <= {2, 3, 4, 6}  # the last version of each post so far


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([("love", 3.2), ("love", 1.0), ("crash", -2.0), ("great", 3.1), (None, 1.0), ("nil", None)], "token string, valence double")


TEXTS = ["I LOVE it", "love", "not great, but a crash!!", "very GREAT crash??", "really not so great", "", None, "nothing known", "so so love but BUT love", "nil love", "Great!!!!! love, 'crash'"]


def test_scores_in_place_equal_the_joined_ones(spark, words):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    joined = {r.id: r.compound for r in lexicon.score_texts(texts, "id", "text", words).collect()}
    placed = lexicon.add_compound(texts, "text", words)
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.compound for r in placed.collect()} == pytest.approx(joined)
    assert lexicon.add_compound(texts.limit(0), "text", words.limit(0)).collect() == []


def test_requests_scored_in_place(spark, words):
    corpus = spark.createDataFrame([(k % 2, ["crash bad down", "love great up"][k % 2] + f" w{k % 5}") for k in range(60)], "labels int, text string")
    by_name = {"stocktwits": models.train(corpus, iterations=5, min_count=0), "twitter": models.train(corpus, iterations=2, min_count=0)}
    kinds = ["stocktwit", "twitter-user", "twitter-topic", "other"]
    rows = [(k, f"{kinds[k % 4]}-sentiment-request", TEXTS[k % len(TEXTS)]) for k in range(20)]
    requests = spark.createDataFrame(rows, "request_id long, msgType string, text string").select("request_id", "msgType", F.struct(F.col("request_id").alias("id"), "text").alias("data"))
    values = ["request_id", "msgType", "predictions.model", "predictions.values.*"]
    joined = scoring.score_requests(requests, by_name, words, processed=F.lit(0).cast("long")).select(*values)
    placed = scoring.score_in_place(requests.coalesce(1), by_name, words, processed=F.lit(0).cast("long"))
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString().replace("coalesce", "")
    got = [tuple(r) for r in placed.select(*values).collect()]
    assert [r[0] for r in got] == [k for k in range(20) if k % 4 != 3]  # in their order
    for a, b in zip(got, sorted(map(tuple, joined.collect()))):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])
