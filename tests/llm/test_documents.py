"""The document operators against plain Python on the smallest tables and on made edge cases."""

import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodgauge.llm import exact, jaccard, mixing, neighbours, packing, rules, subwords
from moodgauge.llm import text as tx
from moodgauge.llm.tables import table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, label string, row string"
LONG = "one two three four five six seven eight nine ten " * 3000


def docs_of(spark, rows):
    """Documents with columns whose names clash with working columns."""
    return spark.createDataFrame([(i, t, None, s, None, 7, "k", "x", None) for i, t, s in rows], COLUMNS)


EDGES = [
    (1, "a b  c\td e f g", "s1"), (2, "a b c d e f g", None), (2, "a b c d e f g", None), (None, "a b\nc d e f g", "s1"), (None, None, None),
    (5, "", "s2"), (6, " \t\n", "s2"), (7, "x", "s2"), (8, "X", "s3"), (9, LONG, "s1"), (10, LONG + "eleven", "s1"), (11, "é ñ ü 日本 語", "s2"), (12, None, "s4"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return docs_of(spark, EDGES)


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality long, toxic long")


def words(text):
    return WORD.findall(text or "")


def test_words_and_hashes():
    texts = ["", "a", " a b ", "b a", None, "\ta\n", "a b"]
    data, offsets = tx.flat(pa.array(texts))
    begin, end, at = tx.words(data, offsets)
    assert np.diff(at).tolist() == [len(words(t)) for t in texts]
    hashes = tx.span_hash(tx.sums(data), begin, end).tolist()
    found = [bytes(data[a:b]) for a, b in zip(begin, end)]
    assert len(set(zip(found, hashes))) == len(set(found)) == len(set(hashes))


def test_chunks_keep_whole_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 50, None, "y" * 500, "z"] * 5})
    got = [t for rows, data, offsets in tx.chunks(batch, "text", 60) for t in [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])]]
    assert got == [t or "" for t in batch.column("text").to_pylist()]


# exact de-duplication


def plain_exact(rows):
    groups = collections.defaultdict(list)
    for n, (i, t, *_) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((i is None, i or 0, n))
    return groups


@pytest.mark.parametrize("digest", [exact.sha256, lambda text: F.substring(exact.sha256(text), 1, 0)], ids=["sha256", "one digest for all"])
def test_exact_groups(edges, digest):
    got = exact.exact_groups(edges, digest).collect()
    want = plain_exact(EDGES)
    assert len(got) == len(EDGES)
    assert collections.Counter((r.keep_id, r.group_size) for r in got) == collections.Counter((EDGES[min(g)[2]][0], len(g)) for g in want.values() for _ in g)
    kept = [r for r in got if r.locator == r.keep_locator]
    assert len(kept) == len(want)


def test_exact_dedup_digest_and_empty(edges, empty):
    got = exact.exact_dedup(edges).collect()
    hashes = {hashlib.sha256(body.encode()).hexdigest() for body in plain_exact(EDGES)}
    assert {r.text_sha256 for r in got} == hashes and sum(r.kept for r in got) == len(hashes)
    assert exact.exact_dedup(empty).collect() == []


def test_without_copies_keeps_columns(spark, tmp_path, edges):
    edges.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = exact.without_copies(docs)
    assert got.columns == docs.columns and got.count() == len(plain_exact(EDGES))


# Jaccard join


def plain_components(rows, n=4, percent=85):
    sets = []
    for _, t, *_ in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None and (find(k) not in least or i < least[find(k)]):
            least[find(k)] = i
    return [(i, len(sets[k]), least.get(find(k))) for k, (i, *_) in enumerate(rows)]


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("boundary", [None, 1, 16])
def test_jaccard_components(spark, boundary):
    rng = np.random.default_rng(3)
    rows = list(EDGES)
    for group in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(4, 40)))]
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            if rng.random() < 0.8:
                copy[int(rng.integers(0, len(copy)))] = f"v{rng.integers(0, 9)}"
            rows.append((100 + len(rows), " ".join(copy) + " end" * int(rng.integers(0, 3)), "s1"))
    got = jaccard.jaccard_components(docs_of(spark, rows), boundary=boundary)
    assert sorted_rows(tuple(r) for r in got.collect()) == sorted_rows(plain_components(rows))


def test_jaccard_given_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted_rows(tuple(r) for r in jaccard.jaccard_components(docs).collect()) == sorted_rows(plain_components(rows))


def test_jaccard_empty(empty):
    assert jaccard.jaccard_components(empty).collect() == []


def test_subsets_meet_exactly_when_sets_link():
    sets = [np.sort(np.random.default_rng(k).choice(20, 9 + k % 3, replace=False).astype(np.uint64)) for k in range(40)]
    sets += [s.copy() for s in sets[:5]] + [np.sort(np.append(s[1:], np.uint64(50))) for s in sets[:9]]

    def names(s):
        return {(*sorted((len(s), other)), *x) for other, t in jaccard.subsets_given(len(s), 20, 85) for x in jaccard.subset_names(s[None, :], len(s), other, t)[0].tolist()}

    given = [names(s) for s in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(set(a.tolist()) & set(b.tolist()))
            meet = {x for x in given[i] & given[j] if x[:2] == tuple(sorted((len(a), len(b))))}
            assert bool(meet) == (100 * common >= 85 * (len(a) + len(b) - common))


# mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want, free, total = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = {s: total * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return want | share
        want |= {s: 2.0 * sizes[s] for s in over}
        total -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return want


def test_mixture(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    got = mixing.mixture(docs).collect()
    sizes = collections.Counter()
    for r in rows.values():
        sizes[r.source] += len(words(r.text))
    want = plain_targets(sizes)
    taken = collections.Counter()
    for r in got:
        source = rows[r.doc_id].source
        assert (r.size, r.source_size) == (len(words(rows[r.doc_id].text)), sizes[source]) and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    longest = max(r.size for r in got)
    assert all(abs(taken[s] - want[s]) <= longest / 2 + 1 for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixture(docs.repartition(3)).collect()))


def test_mixture_in_slices(spark, monkeypatch):
    docs = table(spark, SF_DIR, "documents")
    want = sorted(map(tuple, mixing.mixture(docs).collect()))
    monkeypatch.setattr(mixing, "ORDERED_ROWS", 2)
    monkeypatch.setattr(mixing, "SLICES", 3)
    assert sorted(map(tuple, mixing.mixture(docs).collect())) == want


def test_mixture_edges(edges, empty):
    got = mixing.mixture(edges).collect()
    assert len(got) == len(EDGES) and all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in got)
    assert len({r.taken for r in got if r.doc_id == 2}) == 1
    assert mixing.mixture(empty).collect() == []
    assert mixing.mixed_rows(edges).columns == edges.columns


# packing


def check_pieces(rows, docs_tokens):
    """docs_tokens: the ids of each document in a multiset by doc_id."""
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        used = sum(r.length for r in pieces)
        assert used <= 2048 and used & (used - 1) == 0  # full, so never padded
    for doc_id, pieces in by_doc.items():
        ids = docs_tokens[doc_id]
        assert sum(r.length for r in pieces) == sum(map(len, ids))
        if len(ids) == 1:
            pieces.sort(key=lambda r: r.start)
            assert b"".join(bytes(r.ids) for r in pieces) == np.array(ids[0], "<u4").tobytes()
            assert [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()


def whole_ids(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.word_tokenizer_path())
    out = collections.defaultdict(list)
    for i, t in rows:
        out[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    return out


def test_packing_given_table(spark):
    docs = table(spark, SF_DIR, "documents")
    got = packing.packed(docs).collect()
    check_pieces(got, whole_ids([(r.doc_id, r.text) for r in docs.collect()]))
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in packing.pieces(docs).collect()}
    assert all(digest[r.doc_id, r.start] == zlib.crc32(bytes(r.ids)) for r in got)


def test_packing_edges(edges, empty):
    check_pieces(packing.packed(edges).collect(), whole_ids([(i, t) for i, t, _ in EDGES]))
    assert packing.packed(empty).collect() == []


def test_tokens_of_odd_texts():
    rng = np.random.default_rng(2)
    texts = ["a<|endoftext|>b", "<|ENDOFTEXT|> It's DON'T we'll a'b", "x×y ÷ naïve,…foo‘bar’ ΑΣ σΣ.", "a,̸ 1234 ab12,.;c", "日本 語　x", "🙂a, İ ẞ", "a\x00b,c"]
    texts += ["".join(rng.choice(list("aéB'.,|<>!×́ \nΣ1½㎏ßİ"), 40)) for _ in range(300)]
    ids, at = packing.WordTokens(packing.word_tokenizer_path()).encode(*tx.flat(pa.array(texts)))
    want = whole_ids(enumerate(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [want[k][0] for k in range(len(texts))]


# quality, toxicity, rules


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def rank_quality(pairs):
    """The share of (1, 0) pairs in the right order."""
    pairs = list(pairs)
    ones, zeros = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


@pytest.mark.parametrize("query, column, threshold", [(neighbours.quality, "quality", 0.3), (subwords.toxicity, "toxic", 0.5)])
def test_classifiers_on_held_out_rows(spark, query, column, threshold):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = {r.doc_id: r for r in query(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) and r.held_out == held_out(i) for i, r in got.items())
    pairs = [(got[r.doc_id].score, r[column]) for r in labels.collect() if held_out(r.doc_id)]
    assert rank_quality(pairs) > 0.85


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in neighbours.quality(docs, x).collect()} for x in (labels, turned))
    assert a == pytest.approx(b)


@pytest.mark.parametrize("query", [neighbours.quality, subwords.toxicity, rules.quality_rules])
def test_classifiers_on_edges(spark, edges, empty, query):
    some = labels_of(spark, [(1, 1, 0), (2, 0, 1), (3, 1, 1), (7, 0, 1), (9, 1, 0), (None, 1, 1), (8, None, None)])
    assert query(edges, some).count() == len(EDGES)
    assert query(edges, labels_of(spark)).count() == len(EDGES)
    assert query(empty, some).collect() == []


def test_labelled_text_of_many_equal_shapes(spark):
    """Counts beyond 65,504 are learnt from as they are."""
    docs = docs_of(spark, [(1, "word " * 70_001, "s1"), (2, "A1 b2, c3", "s1"), (3, "word " * 9, "s1"), (7, "(x) [y]", "s1")])
    got = {r.doc_id: r.score for r in neighbours.quality(docs, labels_of(spark, [(1, 1, 0), (2, 0, 0), (3, 1, 0), (7, 0, 0)])).collect()}
    assert len(got) == 4 and all(0 <= x <= 1 for x in got.values())
    vector = neighbours.fit(docs, labels_of(spark, [(1, 1, 0), (3, 1, 0), (7, 0, 0)])).vectors
    assert np.isfinite(vector).all()


def test_misspelt_words_share_vectors():
    rng = np.random.default_rng(1)
    plain = [bytes(rng.integers(97, 123, int(rng.integers(3, 9))).astype(np.uint8)) for _ in range(400)]
    vocabulary = plain + [b"dreadful", b"horrid"]
    texts = [rng.choice(400, 30, replace=False) for _ in range(160)]
    labels = np.arange(160) % 2
    texts = [np.append(t, 400 + k % 4 // 2) if y else t for k, (t, y) in enumerate(zip(texts, labels))]
    model = subwords.train(texts, labels, vocabulary, 12, 0.3, 16)
    logit = subwords.leaning(model.lean, model.bias, *subwords.bags_of([b"dreadfull", b"dredful", b"horid", b"window", b"garden"]))
    assert (logit[:3] > 0).all() and (logit[3:] < 0).all()


def plain_statistics(text):
    text = text or ""
    w, seen, twice = words(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            twice += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    marked = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), twice, len(marked)


def test_rule_statistics(spark, edges):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    got = rules.judged(docs, None).collect()
    want = collections.Counter((i, *plain_statistics(t)) for i, t in docs.collect())
    assert collections.Counter((r.doc_id, *(r[name] for name in rules.BASE)) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and not (r.base_failed and r.kept) for r in got)


def test_trees_never_rise_in_falling_features():
    rng = np.random.default_rng(0)
    rows = rng.random((600, 3))
    labels = ((rows[:, 0] < 0.5) ^ (rng.random(600) < 0.2)).astype(float)
    trees = rules.fit_trees(rows, labels, [0, 2], trees=20)
    for feature in (0, 2):
        higher = rows.copy()
        higher[:, feature] += rng.random(600)
        assert (trees.logit(higher) <= trees.logit(rows) + 1e-12).all()
    assert rank_quality(zip(trees.logit(rows), labels)) > 0.75
    for row, want in zip(rows[:20], trees.logit(rows[:20])):
        total = trees.start
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert total == pytest.approx(want)
