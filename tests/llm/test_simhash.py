"""SimHash fingerprints and their classes against plain Python."""

import os
import re

import numpy as np
import pytest
import xxhash

from moodgauge.llm import catalog, simhash

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, fp long, first long, n long, root long, component_id long, fingerprint string, shard long, node long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *[None] * 8) for i, t in rows], COLUMNS)


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, distance=4):
    """The number of the first value of each value's class."""
    values = np.array(values, np.uint64)
    first = list(range(len(values)))

    def top(k):
        while first[k] != k:
            k = first[k]
        return k

    for k in range(len(values)):
        for other in np.flatnonzero(np.bitwise_count(values[k] ^ values[:k]) <= distance):
            a, b = sorted((top(k), top(int(other))))
            first[b] = a
    return [top(k) for k in range(len(values))]


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    of = plain_classes(prints)
    smallest = {}
    for (doc_id, _), root in zip(rows, of):
        if doc_id is not None:
            smallest[root] = min(smallest.get(root, doc_id), doc_id)
    return [(doc_id, f"{p:016x}", smallest.get(root)) for (doc_id, _), p, root in zip(rows, prints, of)]


def by_text(rows):
    return sorted(rows, key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op11_simhash_links"](spark, SF_DIR).select("doc_id", "fingerprint", "component_id").collect()
    assert by_text(map(tuple, got)) == by_text(expected(rows))


def test_defined_cases(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [
        (5, base), (4, base + " more"), (4, base + " more"), (None, base), (9, None), (8, ""), (7, " \t\n"), (None, "only a null id"), (3, "x"), (2, "X"),
        (10, "one two three"), (11, "ONE  two\nthree"), (12, "É é ÉÉ ß 日本 語"), (13, "one two three four " * 20000),
    ]
    got = simhash.simhash_components(docs_of(spark, rows)).collect()
    assert by_text(map(tuple, got)) == by_text(expected(rows))
    assert simhash.simhash_components(docs_of(spark, [])).collect() == []


def test_a_derived_frame_and_a_long_text(spark):
    long = " ".join(f"{k * k}" for k in range(1_000_000))
    assert len(long) > 8_000_000
    docs = docs_of(spark, [(1, long), (2, long + " end"), (3, "short")]).filter("doc_id > 0").selectExpr("doc_id", "text", "n as kept")
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def clustered(rng, n):
    """Values at random, and dense groups round some of them."""
    near = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    near[n // 2 :] = near[rng.integers(0, 5, n - n // 2)]
    for _ in range(7):
        near ^= np.where(rng.random(n) < 0.5, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
    return np.unique(near)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 64, "shard_queries": 100}, {"shard_rows": 16, "bands": 1}, {"shard_rows": 128, "distance": 6, "bands": 2}])
def test_trees_lose_no_link(spark, options):
    values = clustered(np.random.default_rng(3), 3000)
    fps = spark.createDataFrame([(int(v), k, 1) for k, v in enumerate(values.view(np.int64))], "fp long, first long, n long")
    got = {r.fp: r.component_id for r in simhash.classes(fps, **options).collect()}
    want = plain_classes(values, options.get("distance", 4))
    assert [got[int(v)] for v in values.view(np.int64)] == want


def test_visits_keep_everything_within_reach():
    rng = np.random.default_rng(8)
    values = clustered(rng, 2000)
    for mask in simhash.masks(3):
        tree = simhash.fit(values[::7], mask, 5, 1)
        lies = np.empty(len(values), np.int64)
        row, leaf = simhash.visits(tree, values, 0)
        lies[row] = leaf
        seen = set(zip(*(x.tolist() for x in simhash.visits(tree, values, 1))))
        for k in range(0, len(values), 50):
            near = np.flatnonzero(np.bitwise_count((values ^ values[k]) & mask) <= 1)
            assert all((k, int(lies[j])) in seen for j in near)


def test_links_within_a_leaf_stay_in_proportion():
    rng = np.random.default_rng(1)
    dense = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)))
    found = list(simhash.linked(dense, dense, 4))
    assert sum(len(a) for a, _ in found) <= 4 * 2 * len(dense)


def test_bits_are_counted_over_many_shingles():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    group = np.sort(rng.integers(0, 9, 5000))
    groups, sums = simhash.bit_counts(hashes, group)
    for g, row in zip(groups, sums):
        assert row.tolist() == [int((hashes[group == g] >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
