import math

import pytest
from pyspark.sql import functions as F

from moodgauge.operators import accounts, labelling, lexicon, metrics, models, scoring
from moodgauge.operators import posts as post_ops

ACCOUNT = "id bigint, name string, screen_name string"


def people(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}", f"s{i}") for i in ids], ACCOUNT)


def test_camps(spark, rows):
    leaders, friends, followers = people(spark, 1, 2), people(spark, 2, 3, 4), people(spark, 4, 5)
    assert [r[0] for r in rows(accounts.extended_camp(leaders, friends, followers))] == [1, 2, 4]
    assert [r[0] for r in rows(accounts.extended_camp(leaders, friends, followers, intersect=False))] == [1, 2, 3, 4, 5]
    tagged = accounts.tag_camps(people(spark, 1, 2), people(spark, 2, 3))
    assert rows(tagged, "id", "sentiment") == [(1, "Bullish"), (2, "Bullish"), (3, "Bearish")]


def test_renamed_account(spark, rows):
    both = people(spark, 1).union(spark.createDataFrame([(1, "n1", "a-new")], ACCOUNT))
    assert accounts.any_way(both).count() == 2
    assert rows(accounts.one_row_per_account(both)) == [(1, "n1", "a-new")]


def test_expansion(spark, rows):
    lists = spark.createDataFrame([(10, "bulls"), (11, "bulls"), (12, "bears")], "list_id bigint, camp string")
    members = spark.createDataFrame([(10, 1, "n", "a"), (11, 1, "n", "b"), (12, 2, "n", "c")], "list_id bigint, " + ACCOUNT)
    bulls = accounts.members_of(lists, members, "bulls")
    assert rows(accounts.list_accounts(bulls, ["list_id"])) == [(1, "n", "b")]
    edges = spark.createDataFrame([(1, 7, "n", "late", 5), (1, 7, "n", "early", 4), (2, 8, "n", "x", 1)], "src bigint, " + ACCOUNT + ", place int")
    assert rows(accounts.related_accounts(bulls, edges, ["place"])) == [(7, "n", "early")]


@pytest.fixture(scope="module")
def authored(spark):
    data = [(1, "s1", 35.0, "a &#39;b"), (2, "s9", 250.0, "x"), (3, "s2", 100.0, "y @me"), (4, "s9", 0.0, "z"), (5, None, 0.0, "z")]
    return spark.createDataFrame(data, "post_id bigint, user_name string, impact double, body string")


def test_label_posts(spark, authored, rows):
    camps = accounts.tag_camps(people(spark, 1, 2), people(spark, 3))
    got = labelling.label_posts(authored.union(authored.filter("post_id = 1")), camps, ["s2"])
    assert rows(got, "post_id", "sentiment", "clean_body", "repeat") == [(1, "Bullish", "a 'b", 1), (3, "Bearish", "y", 2)]
    assert rows(labelling.unknown_authors(authored, camps)) == [("s9", 2)]
    left = labelling.label_by_author(authored, camps, "left")
    assert left.count() == 5 and left.filter("id is null").count() == 3


def test_training_rows(spark, rows):
    frame = spark.createDataFrame([("Bullish", "a"), ("Undetermined", "b"), ("Bearish", "c"), ("?", "d")], "sentiment string, clean_body string")
    labelled = labelling.labelled_rows(frame)
    assert rows(labelled, "text", "labels") == [("a", 1), ("c", 0)]
    assert rows(labelling.unlabelled(labelled), "labels") == [(0,), (0,)]
    assert rows(labelling.class_balance(labelled)) == [(2, 0.5)]
    shifted = labelling.shift_labels(labelled.withColumn("labels", F.col("labels") + 4))
    assert rows(shifted, "labels", "n_classes") == [(0, 2), (1, 2)]


def test_repeat_rows(spark, rows):
    frame = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "k string, n int")
    assert rows(labelling.repeat_rows(frame, F.col("n")), "k") == [("a",), ("a",), ("a",), ("b",)]


def test_add_row_id(spark, rows):
    frame = spark.createDataFrame([(5,), (-2,), (1000000007,)], "k bigint")
    assert rows(labelling.add_row_id(frame, "k")) == [(-2, 0), (1000000007, 2), (5, 1)]


def test_metrics(spark, rows):
    pairs = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 3
    frame = spark.createDataFrame(pairs, "label int, prediction int")
    m = metrics.binary_metrics(frame).first()
    assert (m.accuracy, m.precision, m.recall) == pytest.approx((9 / 12, 6 / 7, 6 / 8))
    assert m.f1 == pytest.approx(2 * (6 / 7) * (6 / 8) / (6 / 7 + 6 / 8))
    assert rows(metrics.confusion(frame)) == [(0, 0, 3), (0, 1, 1), (1, 0, 2), (1, 1, 6)]
    report = {r["class"]: r for r in metrics.class_report(frame).collect()}
    assert report[0].support == 4 and report[0].precision == pytest.approx(3 / 5) and report[0].recall == pytest.approx(3 / 4)
    none = metrics.binary_metrics(frame.filter("label = 0 and prediction = 0")).first()
    assert (none.precision, none.recall, none.f1, none.accuracy) == (0, 0, 0, 1)


LEXICON = {"good": 1.9, "great": 3.1, "bad": -2.5, "love": 3.2}


def plain_score(text, lexicon=LEXICON):
    """The published rules in plain Python."""
    words = []
    for raw in text.split():
        bare = raw.strip(lexicon_punctuation)
        words.append(raw if len(bare) <= 2 else bare)
    loud = [w.isupper() for w in words]
    mixed = any(loud) and not all(loud)
    lower = [w.lower() for w in words]
    turn = lower.index("but") if "but" in lower else None
    total = 0.0
    for i, word in enumerate(lower):
        if word not in lexicon:
            continue
        v = lexicon[word]
        if loud[i] and mixed:
            v += math.copysign(0.733, v)
        for distance, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < distance:
                continue
            near = lower[i - distance]
            boost = 0.293 if near in lexicon_module.BOOSTERS else -0.293 if near in lexicon_module.DAMPENERS else 0.0
            if boost and loud[i - distance] and mixed:
                boost += 0.733
            v += math.copysign(1, v) * damping * boost
            if near in lexicon_module.NEGATIONS:
                v *= -0.74
        total += v * (1 if turn is None or i == turn else 0.5 if i < turn else 1.5)
    marks = min(text.count("!"), 4) * 0.292
    asked = text.count("?")
    marks += 0 if asked <= 1 else asked * 0.18 if asked <= 3 else 0.96
    total += math.copysign(marks, total) if total else 0.0
    return round(total / math.sqrt(total * total + 15), 4)


lexicon_module = lexicon
lexicon_punctuation = lexicon.PUNCTUATION

TEXTS = [
    "good", "not good", "very good", "VERY good news", "this is GOOD", "THIS IS GOOD", "good but bad",
    "not very good at all!!", "great! great!! love???", "bad?", "bad????", "so so so good", "slightly bad",
    "never really love it", "", "   ", "nothing here", "but good", "good, great; (bad) :)", "I don't love THE bad BUT great thing",
    "isn't great", "bad!!!!!!", "kinda GREAT and LOVE", "hardly not very good", "ok?? good",
]


def test_lexicon_against_plain_rules(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    table = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    got = {r.id: r.compound for r in lexicon.score_texts(frame, "id", "text", table).collect()}
    want = {n: plain_score(t) for n, t in enumerate(TEXTS)}
    assert got == pytest.approx(want, abs=1e-4)
    assert got[0] == 0.4404 and got[1] == -0.3412  # published examples of one word and its negation


def test_lexicon_shuffles_only_sums(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    table = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    plan = lexicon.score_texts(frame, "id", "text", table)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_sum" in plan


@pytest.fixture(scope="module")
def corpus(spark):
    good, bad = "love great moon profit", "crash fraud bad loss"
    data = [(n, f"word{n % 7} {good if n % 2 else bad} filler{n % 5}", n % 2) for n in range(200)]
    return spark.createDataFrame(data, "id bigint, text string, labels int")


def test_classifier_learns_and_its_scores_sum_to_one(spark, corpus, tmp_path):
    model = models.train(corpus, iterations=10)
    model.write().save(str(tmp_path / "model"))
    again = models.load(str(tmp_path / "model"))
    scores = [r.scores for r in models.probabilities(again, corpus).collect()]
    assert all(sum(s) == pytest.approx(1) for s in scores)
    assert models.evaluate(again, corpus).first().accuracy == 1.0


def test_learning_curve(corpus):
    curve = models.learning_curve(corpus.filter("id < 150"), corpus.filter("id >= 150"), "id", [20, 150], iterations=5)
    got = curve.orderBy("train_size").collect()
    assert [r.train_size for r in got] == [20, 150] and got[0].log10_size == pytest.approx(math.log10(20))
    assert got[1].accuracy == 1.0


def test_training_cuts_texts_twice(spark, corpus):
    """Once for the vocabulary and once for the counts, however many passes a fit makes."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    models.train(corpus.withColumn("text", counted("text")), iterations=5)
    assert seen.value == 2 * 200


def test_topics(corpus):
    got = models.topics(corpus.select(F.col("text").alias("body")), k=3, iterations=2).collect()
    assert len(got) == 3 and all(len(r.terms) == 3 and None not in r.terms for r in got)


def test_score_requests_routes_by_type(spark, corpus):
    model = models.train(corpus, iterations=5)
    data = [(1, "stocktwit-sentiment-request", "love great"), (2, "twitter-user-sentiment-request", "crash bad"),
            (3, "twitter-topic-sentiment-request", ""), (4, "sentiment-request", "no route")]
    requests = spark.createDataFrame(data, "request_id bigint, msgType string, text string").select(
        "request_id", "msgType", F.struct(F.col("request_id").alias("id"), "text").alias("data")
    )
    table = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    got = scoring.score_requests(requests, {"stocktwits": model, "twitter": model}, table)
    by_id = {r.request_id: r for r in got.collect()}
    assert {i: r.predictions.model for i, r in by_id.items()} == {1: "stocktwits", 2: "twitter", 3: "twitter"}
    assert by_id[2].msgType == "twitter-user-sentiment-response"
    for row in by_id.values():
        v = row.predictions["values"]
        assert v.bear_sentiment + v.bull_sentiment == pytest.approx(1)
        assert v.bull_vader_sentiment == pytest.approx(0.8 * v.bull_sentiment + 0.2 * v.vader_sentiment)
    assert by_id[3].predictions["values"].vader_sentiment == 0.5
    assert post_ops.flatten(got.withColumn("data", F.struct("data.id", "data.text", F.lit("2018-08-10T17:17:53Z").alias("created_at"),
                            F.struct(F.lit("u").alias("username"), F.lit("v").alias("screen_name")).alias("user")))
                            .withColumn("clientReceivedTsMs", F.lit(1))).count() == 3
