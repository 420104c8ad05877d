"""The most frequent tokens by sketches against plain counts."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodgauge.operators import vocabulary
from moodgauge.plans import corpus


@pytest.fixture(scope="module")
def lists():
    rng = np.random.default_rng(5)
    return [[f"w{x}" for x in rng.zipf(1.3, 60) if x < 5000] for _ in range(400)] + [[], None, [None, "w1"], ["tie-a", "tie-b"] * 300]


def plain(lists, k):
    counts = collections.Counter(x for row in lists for x in row or [] if x is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]


def as_rows(df):
    return [(r.token, r.n) for r in df.orderBy(F.desc("n"), "token").collect()]


@pytest.mark.parametrize("k, items, candidates", [(10, 4096, 500), (10, 64, 500), (10, 4096, 12), (10, 4096, 10), (10_000, 4096, 500)])
def test_top_tokens_are_exact(spark, lists, k, items, candidates):
    # small sketches and few candidates end in the count of every token
    docs = spark.createDataFrame([(x,) for x in lists], "tokens array<string>").repartition(7)
    assert as_rows(vocabulary.top_tokens(docs, k, items=items, candidates=candidates)) == plain(lists, k)


def test_flat_and_empty(spark):
    flat = spark.createDataFrame([([f"w{x}" for x in range(3000)],)], "tokens array<string>")
    assert as_rows(vocabulary.top_tokens(flat, 3, items=64, candidates=20)) == [("w0", 1), ("w1", 1), ("w10", 1)]
    assert as_rows(vocabulary.top_tokens(flat.limit(0), 3)) == []


def test_sketches_are_few(spark, lists):
    docs = spark.createDataFrame([(x,) for x in lists], "tokens array<string>").repartition(200)
    held = vocabulary.token_sketches(docs)
    assert held.count() <= vocabulary.SKETCH_PARTS
    assert held.agg(F.sum("n")).first()[0] == sum(x is not None for row in lists for x in row or [])


def test_stream_has_a_file_per_part_of_the_scan(spark, lists, tmp_path, monkeypatch):
    texts = [(k, " ".join(x for x in row or [] if x)) for k, row in enumerate(lists)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(11).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    dealt = spark.read.parquet(f"{tmp_path}/documents.parquet").repartition(11).select(F.split("text", " ").alias("tokens"))
    monkeypatch.setattr(corpus.t, "documents", lambda spark, path: dealt)
    got = as_rows(corpus.stream_token_top_sketch(spark, str(tmp_path)))
    assert len(list((tmp_path / "token-lists").glob("part-*"))) == 11
    assert len(list((tmp_path / "sketches").glob("batch_id=*"))) == 2
    assert got == plain([x.split(" ") for _, x in texts], 25)


@pytest.mark.parametrize("least", [1, 40, 10_000_000])
def test_rare_tokens_are_left_out_before_the_count(spark, lists, least):
    docs = spark.createDataFrame([(x,) for x in lists], "tokens array<string>").repartition(5)
    counts = collections.Counter(x for row in lists for x in row or [] if x is not None)
    got = collections.Counter(r.token for r in vocabulary.frequent_tokens(docs, least, buckets=1 << 12).collect())
    assert all(got[x] == n for x, n in counts.items() if n >= least) and all(n == counts[x] for x, n in got.items())
    assert len(got) <= 2 * sum(n >= least for n in counts.values())


def test_tokens_are_not_shuffled_to_their_candidates(spark, lists, monkeypatch):
    plans, plain_most = [], vocabulary.most_common
    monkeypatch.setattr(vocabulary, "most_common", lambda counts, k: plans.append(counts._jdf.queryExecution().executedPlan().toString()) or plain_most(counts, k))
    vocabulary.top_tokens(spark.createDataFrame([(x,) for x in lists], "tokens array<string>"), 10, items=4096, candidates=500)
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0]
