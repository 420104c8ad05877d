"""The word-pair classifier against plain Python."""

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from moodgauge.operators import sequences

TEXTS = [
    (1, "not good at all", 0), (2, "good good good", 1), (3, "very GOOD \t day", 1), (4, "", 1), (5, None, 0), (6, "day", 0),
    (7, "not a good day", 0), (8, "good day " * 3000, 1), (9, "left out good", 2), (10, "left out", None), (11, "\u00fcber gut", 1),
]


def plain_features(text, buckets):
    tokens = (text or "").lower().split()
    found = tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
    return {int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % buckets for x in found}


def plain_ratios(rows, buckets, alpha):
    counts = {k: collections.Counter(f for _, t, y in rows if y == k for f in plain_features(t, buckets)) for k in (0, 1)}
    total = {k: sum(c.values()) + alpha * buckets for k, c in counts.items()}
    return {f: math.log((counts[1][f] + alpha) / total[1] / ((counts[0][f] + alpha) / total[0])) for f in counts[0] | counts[1]}


@pytest.mark.parametrize("buckets", [sequences.BUCKETS, 7, 2 * sequences.BROADCAST_BUCKETS])
@pytest.mark.parametrize("alpha", [1.0, 0.25])
def test_ratios_and_scores(spark, buckets, alpha):
    corpus = spark.createDataFrame(TEXTS, "id long, text string, labels int").repartition(3)
    ratios = sequences.fit(corpus, buckets=buckets, alpha=alpha)
    want = plain_ratios(TEXTS, buckets, alpha)
    assert {r.feature: r.ratio for r in ratios.collect()} == pytest.approx(want)
    bias = sequences.prior(corpus, alpha=alpha)
    assert bias == pytest.approx(math.log((5 + alpha) / (4 + alpha)))
    got = {r.id: r for r in sequences.score(corpus, ratios, bias, "id", buckets=buckets).collect()}
    assert len(got) == len(TEXTS)
    for key, text, _ in TEXTS:
        score = bias + sum(want.get(f, 0) for f in plain_features(text, buckets))
        assert got[key].score == pytest.approx(score) and got[key].prediction == (score > 0)


def test_order_of_words_counts(spark):
    rows = [(k, *(("a b", 1) if k % 2 else ("b a", 0))) for k in range(8)]
    corpus = spark.createDataFrame(rows, "id long, text string, labels int")
    ratios, bias = sequences.fit(corpus), sequences.prior(corpus)
    got = {r.id: r.prediction for r in sequences.score(corpus, ratios, bias, "id").collect()}
    assert got == {k: y for k, _, y in rows}


def test_without_rows(spark):
    corpus = spark.createDataFrame(TEXTS, "id long, text string, labels int")
    nothing = sequences.fit(corpus.limit(0))
    assert nothing.collect() == [] and sequences.prior(corpus.limit(0)) == 0
    got = sequences.score(corpus, nothing, 0.0, "id").agg(F.count("*"), F.max(F.abs("score"))).first()
    assert tuple(got) == (len(TEXTS), 0.0)
    assert sequences.score(corpus.limit(0), sequences.fit(corpus), 0.0, "id").collect() == []
