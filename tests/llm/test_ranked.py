"""Ranked search against plain Python."""

import collections
import math
import os
import re

import duckdb
import numpy as np
import pytest

from moodgauge.llm import catalog, ranked

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id string, n string, terms string, times string, part int, score int, rank int"
ITEMS = "item_id long, text string, term string, doc_id string, item int, word string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *[None] * 7) for i, t in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, *[None] * 4) for i, t in rows], ITEMS)


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k=50):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    wanted = collections.defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for doc_id, c, n in counted:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def given(spark, name, key):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(key, "text").collect()]


def test_query_against_plain_python_and_sql(spark):
    rows = got(catalog.QUERIES["op13_ranked_search"](spark, SF_DIR))
    assert rows == expected(given(spark, "documents", "doc_id"), given(spark, "benchmark", "item_id"))
    with duckdb.connect() as connection:
        for name in ("documents", "benchmark"):
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
        assert rows == sorted(connection.sql(catalog.SQL["op13_ranked_search"]).fetchall(), key=str)


EDGES = [
    (1, "alpha beta gamma"), (2, "Alpha, beta-gamma; ALPHA!"), (2, "Alpha, beta-gamma; ALPHA!"), (None, "alpha beta gamma"), (None, None), (3, ""), (4, " \n--"),
    (5, "É é Ünder_score x1 1x"), (6, "日本語 テキスト alpha"), (7, "zeta " * 500), (8, "alpha"), (9, "alpha"), (10, "alpha"), (-3, "alpha"), (11, "y" * 300), (12, "y" * 299 + "z"),
]
ASKED = [(1, "alpha"), (1, "zeta"), (2, "é under score 日本語"), (None, "beta"), (3, None), (4, ""), (5, "nowhere"), (6, "y" * 300 + " x1"), (7, "ALPHA alpha"), (7, "ALPHA alpha")]


@pytest.mark.parametrize("options", [{}, {"k": 3}, {"k": 3, "postings": 4}, {"k": 2, "item_rows": 2}])
def test_defined_cases(spark, options):
    docs, items = docs_of(spark, EDGES).repartition(2), items_of(spark, ASKED)
    assert got(ranked.ranked(docs, items, **options)) == expected(EDGES, ASKED, options.get("k", 50))


def test_empty_tables(spark):
    assert got(ranked.ranked(docs_of(spark, []), items_of(spark, ASKED))) == []
    assert got(ranked.ranked(docs_of(spark, EDGES), items_of(spark, []))) == []
    assert got(ranked.ranked(docs_of(spark, [(1, None)]), items_of(spark, ASKED))) == []


def test_random_texts_in_many_shards(spark):
    rng = np.random.default_rng(6)
    words = np.array([f"w{k}" for k in range(300)])
    chance = 1 / np.arange(1, 301)
    docs = [(int(rng.integers(0, 400)), " ".join(rng.choice(words, rng.integers(1, 60), p=chance / chance.sum()))) for _ in range(600)]
    items = [(k, " ".join(rng.choice(words, rng.integers(1, 12)))) for k in range(12)]
    assert got(ranked.ranked(docs_of(spark, docs).repartition(4), items_of(spark, items), k=10, postings=500)) == expected(docs, items, 10)


def test_the_search_stops_early_and_only_strictly_below():
    rng = np.random.default_rng(7)
    n, weight = 20_000, np.array([5, 900, 40], np.int64)
    counts = np.full(n, 3)
    held = np.tile(np.arange(3), n)
    times = np.where(held == 1, (rng.random(3 * n) < 0.005) * 3, rng.integers(1, 4, 3 * n))
    some = times > 0
    counts = np.add.reduceat(some, np.arange(0, 3 * n, 3))
    size = np.full(n, 100)
    shard = ranked.Shard(np.arange(n), size, counts, held[some], times[some], weight)
    impact = weight[held] * (1_000_000_000 * times // (1000 * times + 2000))
    score = impact.reshape(n, 3).sum(axis=1)
    for known in (np.zeros(0, np.int64), np.full(10, score.max())):
        found, scores, looked = shard.search(np.arange(3), 10, known)
        best = np.lexsort((np.arange(n), -score))[:10]
        best = best[score[best] >= (known.min() if len(known) else 0)]
        assert found.tolist() == best.tolist() and scores.tolist() == score[best].tolist()
        assert looked < n / 4
    flat = ranked.Shard(np.arange(n), size, np.ones(n, np.int64), np.zeros(n, np.int64), np.ones(n, np.int64), weight)
    found, _, looked = flat.search(np.array([0]), 10, np.zeros(0, np.int64))
    assert found.tolist() == list(range(10)) and looked == n  # all tie, so none may be left out


def test_terms_with_equal_hashes_are_told_by_their_bytes(monkeypatch):
    monkeypatch.setattr(ranked.tx, "span_hash", lambda running, begin, end: np.full(len(begin), 7, np.uint64))
    known = ranked.Terms([b"one", b"two", b"x" * 100])
    data = np.frombuffer(b"two one six " + b"x" * 100, np.uint8)
    assert known.find(data, np.array([0, 4, 8, 12]), np.array([3, 7, 11, 112])).tolist() == [1, 0, -1, 2]


def test_a_long_text(spark):
    text = " ".join(f"t{k % 5000}" for k in range(1_600_000))
    assert len(text) > 8_000_000
    docs, items = [(1, text), (2, "t1 t2"), (3, "t4999")], [(1, "t1 t4999")]
    assert got(ranked.ranked(docs_of(spark, docs).filter("doc_id > 0"), items_of(spark, items))) == expected(docs, items)
