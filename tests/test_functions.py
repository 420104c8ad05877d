import html
import math
import re

import pytest
from pyspark.sql import functions as F

from moodgauge.functions import moments, numeric, text


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "raw, want",
    [
        ("wouldn&#39;t", "wouldn&'t"),
        ("a &amp; b", "a && b"),
        ("x<br />y", "x\ny"),
        ("one\\ntwo", "one\ntwo"),
        ('say \\"hi\\"', 'say "hi"'),
        ("back\\slash", "back \\ slash"),
        ("3 @.@ 5 and a @-@ b <unk>", "3.5 and a-b u_n"),
        ("wide    gap", "wide gap"),
        ("&lt;tag&gt; &eacute;", "<tag> é"),
        ("plain", "plain"),
    ],
)
def test_clean_post(spark, raw, want):
    assert one(spark, text.clean_post(F.col("t")), t=raw) == want


def test_clean_post_keeps_null(spark):
    frame = spark.createDataFrame([(None,), ("a&lt;b",)], "t string")
    assert [r[0] for r in frame.select(text.clean_post(F.col("t"))).collect()] == [None, "a<b"]


def test_clean_unescape_first(spark):
    assert one(spark, text.clean_post(F.col("t"), unescape_first=True), t="it&#39;s &amp; &quot;x&quot;") == 'it\'s & "x"'


@pytest.mark.parametrize(
    "raw, want",
    [
        ("wouldn&#39;t", "wouldn't"),
        ("@bob look https://t.co/Ab?x=1  now", "look now"),
        ("line\nbreak @é_1 end", "line break end"),
    ],
)
def test_clean_tweet(spark, raw, want):
    assert one(spark, text.clean_tweet(F.col("t")), t=raw) == want


def test_clean_post_is_the_plain_rule(spark):
    """Against the rule spelled out in plain Python on awkward strings."""
    samples = ["&amp;amp;lt; x", "\\\\n \\n", "#36;5 &nbsp;&nbsp; @.@", "a  &copy;  b", "<br /><br />", "", " \\' "]

    def plain(value):
        for old, new in text.REPLACEMENTS:
            value = value.replace(old, new)
        return re.sub("  +", " ", html.unescape(value))

    frame = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, t string")
    got = [r[0] for r in frame.orderBy("i").select(text.clean_post(F.col("t"))).collect()]
    assert got == [plain(s) for s in samples]


def test_tags(spark):
    assert one(spark, text.tag_document(F.col("a"), F.col("b")), a="hi", b=3) == "\nxbos xfld 1 hi xfld 2 3"
    assert one(spark, text.tag_for_scoring(F.col("a")), a="hi") == "xbos xfld 1 hi"


@pytest.mark.parametrize("raw, want", [(" A  b\tC\n", ["a", "b", "c"]), ("", []), (" \n ", []), ("x", ["x"])])
def test_words(spark, raw, want):
    assert one(spark, text.words(F.col("t")), t=raw) == want


def test_label_prefix(spark):
    label, body = text.split_label_prefix(F.col("t"))
    both = F.struct(label.alias("l"), body.alias("b"))
    assert tuple(one(spark, both, t="__label__1 bad")) == (0, " bad")
    assert tuple(one(spark, both, t="__label__2 fine")) == (1, " fine")


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Mon Sep 10 13:05:35 +0000 2018", 1536584735000),
        ("2018-08-10T17:17:53Z", 1533921473000),
        ("not a date", None),
    ],
)
def test_epoch_ms(spark, raw, want):
    assert one(spark, moments.epoch_ms(F.col("t")), t=raw) == want


def test_impact(spark):
    def value(kind, likes, interactions):
        frame = spark.createDataFrame([(kind, likes, interactions)], "k string, l bigint, i bigint")
        return frame.select(numeric.impact(F.col("k"), F.col("l"), F.col("i"))).first()[0]

    assert value("twitter-user", 19, 5) == 35
    assert value("twitter-topic", 19, 5) == 35
    assert value("stocktwit", 3, 1) == 5
    assert value("stocktwit", None, None) == 1


def test_softmax_and_argmax(spark):
    got = one(spark, numeric.softmax(F.col("a")), a=[0.0, 200.0, 10.0])
    assert sum(got) == pytest.approx(1) and got == pytest.approx([0, 1, 0], abs=1e-4)
    values = [0.3, -1.2, 2.0]
    total = sum(math.exp(v) for v in values)
    assert one(spark, numeric.softmax(F.col("a")), a=values) == pytest.approx([math.exp(v) / total for v in values])
    assert one(spark, numeric.argmax(F.col("a")), a=values) == 2
    assert one(spark, numeric.argmax(F.col("a")), a=[1.0, 1.0]) == 0


def test_blend_has_both_published_weights(spark):
    assert one(spark, numeric.blend(F.col("m"), F.col("v")), m=0.592375, v=0.5258) == pytest.approx(0.57906)
    assert one(spark, numeric.blend(F.col("m"), F.col("v"), 0.6), m=0.592375, v=0.5258) == pytest.approx(0.565745)
    assert one(spark, numeric.to_unit_range(F.col("v")), v=-1.0) == 0.0


@pytest.mark.parametrize("impact, want", [(35.0, 1), (199.99, 2), (250.0, 3), (0.0, 1)])
def test_repeat_factor(spark, impact, want):
    assert one(spark, numeric.repeat_factor(F.col("i")), i=impact) == want


def test_numeric_label(spark):
    frame = spark.createDataFrame([("Bullish",), ("Bearish",), ("Undetermined",), ("Other",), (None,)], "s string")
    assert [r[0] for r in frame.select(numeric.numeric_label(F.col("s"))).collect()] == [1, 0, 2, None, None]


def test_numeric_entities_of_any_length(spark):
    texts = ["a &#" + "1" * 5000 + "; b", "&#" + "0" * 5000 + "65;x", "&#99999999", "&#x41;&#65;&amp;", "&#00000000;"]
    want = ["a \ufffd b", "Ax", "\ufffd", "AA&", "\ufffd"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = rows.select("id", text.unescape_html(F.col("text")).alias("text")).collect()
    assert [r.text for r in sorted(got)] == want
