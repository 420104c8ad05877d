"""Reading pages: the scanner against plain patterns, hostile pages, and trigram likelihoods against plain Python."""

import collections
import html
import math
import random
import re
import time

import pytest

from moodgauge.llm import language

HIDDEN = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)
PIECES = ["<", ">", "<!--", "-->", "<script", "</script>", "</SCRIPT  >", "<style>", "</style", "<p>", "a", " ", "&amp;", "<html", "<HTML ", "lang", "=", "'", '"', "fr", "-", "\n", "x", "<template>", "</template>", "</"]


def test_scanner_equals_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        page = "".join(rng.choices(PIECES, k=rng.randrange(1, 25)))
        assert language.visible(page) == html.unescape(HIDDEN.sub(" ", page)), page
        found = DECLARED.search(page)
        assert language.declared(page) == (found[1].lower() if found else ""), page


HOSTILE = ["<script>", "<!--", "<html ", "<", "</script", "<html lang=" + " " * 50, "&#" + "1" * 5000, "<style><script><!--", "<html lang", "< " * 4]


@pytest.mark.parametrize("piece", HOSTILE)
def test_hostile_pages_take_time_in_proportion(piece):
    page = piece * ((1 << 20) // len(piece))
    start = time.process_time()
    language.visible(page), language.declared(page)
    language.visible(page + ">"), language.declared(page + ">")
    assert time.process_time() - start < 4


def test_spaces_without_a_value():
    page = "<html lang=" + " " * (1 << 20)
    start = time.process_time()
    assert language.declared(page) == "" and time.process_time() - start < 1


def bucket(gram: bytes) -> int:
    import numpy as np

    from moodgauge.llm import text as tx

    return int(tx.mix(np.array([gram[0] << 16 | gram[1] << 8 | gram[2]], np.uint64))[0] % np.uint64(language.BUCKETS))


def test_trigram_likelihoods(spark, monkeypatch):
    docs = [("the cat sat on the mat", "en"), ("The Other Cat", "en"), ("le chat est assis", "fr"), ("ab", "xx"), ("", "fr"), (None, "en"), ("zzz", None), ("der hund", "de")]
    pages = [(1, "http://a.b/", "<p>the chat</p> sat"), (2, None, "<b>x</b>"), (3, "http://c.d", None), (4, "http://c.d", "le &eacute;t&eacute; &#" + "9" * 5000 + ";")]
    monkeypatch.setattr(language, "HELD_LANGUAGES", 2)
    frame = spark.createDataFrame([(t, k, "clash") for t, k in docs], "text string, lang string, bucket string")
    names, model = language.gram_model(frame)
    assert names == ["de", "en", "fr"]  # no trigram, no candidate
    counts = collections.defaultdict(collections.Counter)
    for text, lang in docs:
        raw = (text or "").lower().encode()
        if lang:
            counts[lang].update(bucket(raw[k : k + 3]) for k in range(len(raw) - 2))
    given = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, like string, chance string")
    got = {r.page_id: r for r in language.evidence(given, names, model).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    for page_id, _, page in pages:
        raw = language.visible(page).encode().lower()
        like = []
        for name in names:
            own, all_of = counts[name], sum(counts[name].values()) + 0.1 * language.BUCKETS
            like.append(sum(math.log((own[bucket(raw[k : k + 3])] + 0.1) / all_of) for k in range(len(raw) - 2)) / 3)
        assert got[page_id].like == pytest.approx([x - max(like) for x in like], rel=1e-4, abs=1e-4)
    empty = language.identify(given.limit(0), frame)
    assert empty.collect() == [] and "lang" in empty.columns
