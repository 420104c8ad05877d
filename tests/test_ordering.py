import random

import pytest
from pyspark.sql import functions as F

from moodgauge.operators import ordering, packing, splits, vocabulary


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows, a third of them under one key, ids large and unevenly spread."""
    rng = random.Random(5)
    ids = rng.sample(range(10**6), 3999) + [9_007_199_254_740_993 * 3]
    data = [(i, "hot" if n % 3 == 0 else f"k{n % 50}", rng.randint(-5, 9)) for n, i in enumerate(ids)]
    return data, spark.createDataFrame(data, "id bigint, key string, value int").repartition(7)


@pytest.mark.parametrize("by, width", [((), None), (("key",), None), ((), 7), (("key",), 1000)])
def test_running_totals(skewed, by, width):
    data, frame = skewed
    got = {r.id: r.before for r in ordering.running_totals(frame, "id", {"value": "before"}, by, width).collect()}
    sums, want = {}, {}
    for i, key, value in sorted(data):
        group = key if by else None
        want[i] = sums.get(group, 0)
        sums[group] = want[i] + value
    assert got == want


def test_running_totals_of_negative_orders(spark):
    data = [(i, 1) for i in range(-3000, 3000, 7)]
    frame = spark.createDataFrame(data, "id bigint, value int")
    got = {r.id: r.n for r in ordering.running_totals(frame, "id", {"value": "n"}, width=100).collect()}
    assert got == {i: n for n, (i, _) in enumerate(data)}


def test_number_rows(skewed):
    data, frame = skewed
    got = {r.id: r.n for r in ordering.number_rows(frame, "id", "n").collect()}
    assert got == {i: n for n, (i, _, _) in enumerate(sorted(data))}
    got = {r.id: r.n for r in ordering.number_rows(frame, "id", "n", lead="value").collect()}
    assert got == {r[0]: n for n, r in enumerate(sorted(data, key=lambda r: (-r[2], r[0])))}


def test_first_and_last_per_key(skewed):
    data, frame = skewed
    first = {r.key: (r.id, r.value) for r in ordering.first_per_key(frame, ["key"], ["value", "id"]).collect()}
    last = {r.key: (r.id, r.value) for r in ordering.last_per_key(frame, ["key"], ["value", "id"]).collect()}
    for key in {r[1] for r in data}:
        mine = sorted((v, i) for i, k, v in data if k == key)
        assert first[key] == mine[0][::-1] and last[key] == mine[-1][::-1]


def test_first_per_key_aggregates_before_the_shuffle(skewed):
    plan = ordering.first_per_key(skewed[1], ["key"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") >= 1 and "Window" not in plan


@pytest.mark.parametrize("width", [1, 10_000, 10**9])
def test_with_previous(skewed, width):
    data, frame = skewed
    seen = ordering.with_previous(frame, ["key"], ["id"], ["value"], ordering.whole(F.col("id"), width))
    got = {r.id: None if r.previous is None else r.previous.value for r in seen.collect()}
    want, last = {}, {}
    for i, key, value in sorted(data):
        want[i], last[key] = last.get(key), value
    assert got == want


def test_with_previous_keeps_null_values(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None)], "k string, t bigint, v int")
    got = ordering.with_previous(frame, ["k"], ["t"], ["v"], F.col("t"))
    assert {r.t: r.previous for r in got.collect()} == {1: None, 2: (None,), 3: (5,)}


@pytest.mark.parametrize("rank", [0, 1, 17, 4000, 4001])
def test_cutoff(skewed, spark, rank):
    data, frame = skewed
    keys = frame.select(ordering.shuffle_key(F.col("id"), 3).alias("key"))
    ordered = sorted(r.key for r in keys.collect())
    got = spark.range(1).select(ordering.cutoff(keys, rank).alias("c")).first().c
    assert got == (ordered[rank - 1] if 0 < rank <= len(ordered) else None)


@pytest.mark.parametrize("limit", [1, 10, 25, 60, 500])
def test_top_by_count(spark, limit):
    rng = random.Random(limit)
    data = [(f"t{n}", rng.choice([3, 3, 3, 4, 9, 50])) for n in range(200)]
    got = ordering.top_by_count(spark.createDataFrame(data, "token string, n bigint"), limit)
    want = sorted(data, key=lambda r: (-r[1], r[0]))[:limit]
    assert [(r.token, r.n, r["rank"]) for r in got.orderBy("rank").collect()] == [
        (*row, place) for place, row in enumerate(want, start=1)
    ]


@pytest.mark.parametrize("train, validate", [(0.75, 0.0), (0.6, 0.15), (0.0, 0.5), (1.0, 0.0)])
def test_split_sizes_are_exact(skewed, train, validate):
    _, frame = skewed
    got = splits.split_rows(frame, "id", train, validate, seed=2)
    sizes = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    m = 4000
    want = {"train": int(train * m), "validate": int(validate * m)}
    want["test"] = m - sum(want.values())
    assert sizes == {k: v for k, v in want.items() if v}
    again = {(r.id, r.split) for r in splits.split_rows(frame.repartition(3), "id", train, validate, seed=2).collect()}
    assert again == {(r.id, r.split) for r in got.collect()}


def test_split_moves_no_rows(skewed):
    plan = splits.split_rows(skewed[1], "id")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    # the one exchange left is the fixture's own repartition
    assert main.count("Exchange hashpartitioning") == 0


def test_samples_are_exact_and_nested(skewed):
    _, frame = skewed
    small = {r.id for r in splits.sample_rows(frame, "id", 30, seed=8).collect()}
    large = {r.id for r in splits.sample_rows(frame, "id", 300, seed=8).collect()}
    assert len(small) == 30 and len(large) == 300 and small < large
    assert splits.sample_rows(frame, "id", 10**6).count() == 4000


def docs_of(spark, lengths):
    """Documents whose ids count on: the whole sequence is 0, 1, 2, ..."""
    data, at = [], 0
    for key, size in sorted(lengths.items()):
        data.append((key, list(range(at, at + size))))
        at += size
    return at, spark.createDataFrame(data, "doc bigint, ids array<int>").repartition(5)


@pytest.mark.parametrize("lanes, block", [(1, 7), (1, 100), (4, 7), (5, 1000), (52, 70)])
def test_pack(spark, lanes, block):
    rng = random.Random(lanes * block)
    lengths = {k * k: rng.choice([0, 1, 2, 5, 40]) for k in range(120)}
    lengths[10**7] = 3000  # one document as long as all others
    total, docs = docs_of(spark, lengths)
    got = {(r.lane, r.block): r.ids for r in packing.pack(docs, "doc", "ids", block, lanes).collect()}
    lane_len = total // lanes
    want = {}
    for lane in range(lanes):
        ids = list(range(lane * lane_len, (lane + 1) * lane_len))
        want.update({(lane, n): ids[n * block:(n + 1) * block] for n in range(-(-lane_len // block))})
    assert got == want


def test_pack_of_fewer_tokens_than_lanes(spark):
    _, docs = docs_of(spark, {1: 2, 2: 1})
    assert packing.pack(docs, "doc", "ids", 70, 52).count() == 0


def test_length_batches_and_padding(spark):
    rng = random.Random(3)
    lengths = {k: rng.choice([1, 4, 4, 4, 9]) for k in range(103)}
    _, docs = docs_of(spark, lengths)
    batches = packing.length_batches(docs, "doc", "ids", 10)
    got = {r.doc: r.batch for r in batches.collect()}
    order = sorted(lengths, key=lambda k: (-lengths[k], k))
    assert got == {k: n // 10 for n, k in enumerate(order)}
    for r in packing.pad_batches(batches).collect():
        widest = max(lengths[k] for k in lengths if got[k] == r.batch)
        assert len(r.ids) == widest and set(r.ids[lengths[r.doc]:]) <= {1}
    for r in packing.pad_buckets(docs, 3).collect():
        assert r.bucket == lengths[r.doc] // 3
        assert len(r.ids) == max(n for n in lengths.values() if n // 3 == r.bucket)


def test_sortish_batches(spark):
    rng = random.Random(4)
    lengths = {k: rng.choice([1, 4, 4, 4, 9]) for k in range(205)}
    _, docs = docs_of(spark, lengths)
    got = {r.doc: r.batch for r in packing.sortish_batches(docs, "doc", "ids", 4, 5).collect()}
    sizes = [list(got.values()).count(b) for b in sorted(set(got.values()))]
    assert sizes[:-2] == [4] * (len(sizes) - 2) and sum(sizes) == 205
    for chunk in range(11):
        inside = sorted((b, lengths[k]) for k, b in got.items() if b // 5 == chunk)
        for (b1, _), (b2, _) in zip(inside, inside[1:]):
            if b1 < b2:
                assert min(n for b, n in inside if b == b1) >= max(n for b, n in inside if b == b2)


def test_blocks_of_clustered_ids_stay_small(spark):
    """Two id spaces, ten orders of magnitude apart, each dense."""
    ids = list(range(130_000_000, 130_020_000)) + list(range(10**18, 10**18 + 20_000))
    frame = spark.createDataFrame([(i,) for i in ids], "id bigint")
    blocks = ordering._quantile_blocks(frame, "id").groupBy("_group", "_block").count()
    assert blocks.agg(F.max("count")).first()[0] <= len(ids) // 100
    got = {r.id: r.n for r in ordering.number_rows(frame, "id", "n").collect()}
    assert got == {i: n for n, i in enumerate(ids)}


def test_vocabulary_and_encoding(spark):
    data = [(1, ["a", "b", "a", "c", "c", "c"]), (2, []), (3, ["c", "a", "zz", "b", "b"]), (4, None)]
    docs = spark.createDataFrame(data, "doc bigint, tokens array<string>")
    counts = vocabulary.token_counts(docs)
    assert {tuple(r) for r in counts.collect()} == {("a", 3), ("b", 3), ("c", 4), ("zz", 1)}
    vocab = vocabulary.build_vocabulary(counts, max_tokens=2)
    assert {tuple(r) for r in vocab.collect()} == {("_unk_", 0), ("_pad_", 1), ("c", 2), ("a", 3)}
    got = {r.doc: r.ids for r in vocabulary.encode(docs, vocab, "doc").collect()}
    assert got == {1: [3, 0, 3, 2, 2, 2], 2: [], 3: [2, 3, 0, 0, 0], 4: []}
    assert [r.token for r in vocabulary.most_common(counts, 2).collect()] == ["c", "a"]
    assert [r.token for r in vocabulary.least_common(counts, 2).collect()] == ["zz", "b"]
    assert vocabulary.vocabulary_as_list(vocab).first().tokens == ["_unk_", "_pad_", "c", "a"]


def test_align_embeddings(spark):
    vocab = spark.createDataFrame([("_unk_", 0), ("a", 1), ("b", 2)], "token string, id int")
    known = spark.createDataFrame([("a", [1.0, 2.0]), ("x", [3.0, 6.0])], "token string, vector array<float>")
    got = {r.token: (r.pretrained, r.vector) for r in vocabulary.align_embeddings(vocab, known).collect()}
    assert got == {"_unk_": (False, [2.0, 4.0]), "a": (True, [1.0, 2.0]), "b": (False, [2.0, 4.0])}
