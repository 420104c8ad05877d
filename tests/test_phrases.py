"""Rules of the lexicon that look at several words, by their published meaning."""

import math

import pytest

from moodgauge.operators import lexicon

WORDS = {"good": 2.0, "bad": -2.0, "die": -3.0, "ass": -2.5, "kind": 2.4, "heart": 1.0, ":)": 2.0, ":-(": -1.5, "right": 1.0, "death": -2.9, "bomb": -2.0}

# text, and the sum of the valences that it has
CASES = [
    ("a good day", 2.0),
    ("the bomb", 3.0),
    ("bad ass", 1.5 + 1.5),
    ("yeah right", -2.0),
    ("kiss of death", -1.5),
    ("a broken heart", -2.9),
    ("something to die for", -3.0),
    ("kind of good", 2.0 - 0.293),
    ("kind of a good day", 2.0 - 0.293),
    ("so kind", 2.4 + 0.293),
    ("kind of", 0.0),
    ("least good", -0.74 * 2.0),
    ("at least good", 2.0),
    ("the very least good", 2.0 + 0.95 * 0.293),
    ("never so good", 1.25 * (2.0 + 0.293)),
    ("never this good", 1.25 * 2.0),
    ("never good", -0.74 * 2.0),
    ("never was so good", 1.25 * (2.0 + 0.293)),
    ("without doubt good", 2.0),
    ("without a doubt good", 2.0),
    ("without good", -0.74 * 2.0),
    (":) and :-(", 0.5),
    ("", 0.0),
    (None, 0.0),
    ("die", -3.0),
]


@pytest.fixture(scope="module")
def scored(spark):
    words = spark.createDataFrame(list(WORDS.items()), "token string, valence double")
    texts = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(CASES)], "id long, text string")
    frame = lexicon.add_compound(texts, "text", words, phrases=lexicon.Phrases())
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    return {r.id: r.compound for r in frame.collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_rule(scored, k):
    total = CASES[k][1]
    assert scored[k] == pytest.approx(round(total / math.sqrt(total * total + 15), 4), abs=1e-4)


def test_no_rules_are_the_plain_scores(spark):
    words = spark.createDataFrame(list(WORDS.items()), "token string, valence double")
    texts = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(CASES)], "id long, text string")
    none = lexicon.Phrases({}, {}, "", (), "", (), "", "", ())
    plain, same = (lexicon.add_compound(texts, "text", words, phrases=p).collect() for p in (None, none))
    assert sorted(plain, key=lambda r: r.id) == sorted(same, key=lambda r: r.id)


ODD = [
    "good\x0bnews\x0cbad\tnews", "good\u00a0news good\u0085bad", "ΑΣ ΑΣ. 'ΟΔΟΣ' good", "İi GOOD", "STRASSE straße GOOD", "\ua7cb GOOD AB\u0264 \u1c89x", "!!! ?? ...",
    "good " * 50 + "VERY bad but very, (good) BUT bad", "but but good", "'' good '", "  bad  ", "never GOOD, so so Bad; isn't (bad)?",
]


@pytest.mark.parametrize("size", [1, 1 << 22])
def test_in_place_scores_are_the_joined_ones(spark, monkeypatch, size):
    monkeypatch.setattr(lexicon, "TEXT_BYTES", size)
    words = spark.createDataFrame([*WORDS.items(), ("ας", 1.5), ("οδος", -0.5), ("straße", 1.0), ("i\u0307i", 2.0), ("\u0264", 3.0), ("none", None)], "token string, valence double")
    texts = spark.createDataFrame([(k, x) for k, x in enumerate([*ODD, *[x for x, _ in CASES]])], "id long, text string")
    want = {r.id: r.compound for r in lexicon.score_texts(texts, "id", "text", words).collect()}
    assert {r.id: r.compound for r in lexicon.add_compound(texts, "text", words).collect()} == want
    assert len(set(want.values())) > 10


def test_rules_look_at_distinct_words(spark):
    """Nothing is worked out for each word by expressions over arrays."""
    words = spark.createDataFrame(list(WORDS.items()), "token string, valence double")
    plan = lexicon.add_compound(spark.createDataFrame([("good",)], "text string"), "text", words, phrases=lexicon.Phrases())._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
