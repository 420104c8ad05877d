"""Language-model scoring, language identification, components and the pipeline against plain Python."""

import collections
import math
import os
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from moodgauge.llm import cross_entropy, language, neighbours
from moodgauge.llm.graph import components
from moodgauge.llm.tables import table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (150, 2))] + [(k, k + 1) for k in range(400, 470)] + [(999, k) for k in range(600, 640)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = collections.defaultdict(set)
    for a, b in links:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    assert set(got) == set(near)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert {got[x] for x in seen} == {got[node]} and len([x for x in got if got[x] == got[node]]) == len(seen)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# language-model scoring


def plain_losses(texts, target, rarest, least=2):
    tokens = [t.lower().split() for t in texts]
    total = [sum(len(t) for t, y in zip(tokens, target) if y), sum(map(len, tokens))]
    every = collections.Counter(w for t in tokens for w in t)
    vocabulary = {w for w, n in every.items() if n >= max(least, rarest * total[1])}
    tokens = [[w if w in vocabulary else None for w in t] for t in tokens]
    out = []
    singles = [collections.Counter(w for t, y in zip(tokens, target) if y or k for w in t) for k in (0, 1)]
    pairs = [collections.Counter(p for t, y in zip(tokens, target) if y or k for p in zip(t, t[1:])) for k in (0, 1)]
    kept = {p for p in pairs[1] if pairs[1][p] >= max(least, rarest * total[1]) or pairs[0][p] >= max(least, rarest * total[0])}
    for k in (0, 1):
        room = len(vocabulary) + 1

        def chance(w):
            return (singles[k][w] + cross_entropy.SMOOTHING) / (total[k] + cross_entropy.SMOOTHING * room)

        share = {p: max(pairs[k][p] - cross_entropy.DISCOUNT, 0) / max(singles[k][p[0]], 1) for p in kept}
        used = collections.Counter()
        for p, x in share.items():
            used[p[0]] += x
        mass = {w: min(max(1 - used[w], 1e-6), 1) for w in [*vocabulary, None]}
        losses = []
        for t in tokens:
            loss = [-math.log(chance(w)) for w in t[:1]]
            loss += [-math.log(share.get(p, 0) + mass[p[0]] * chance(p[1])) for p in zip(t, t[1:])]
            losses.append(sum(loss) / max(len(t), 1))
        out.append(losses)
    return out


@pytest.mark.parametrize(("rarest", "least"), [(cross_entropy.RAREST, 2), (0.02, 2), (0.0, 1)])
def test_cross_entropy(spark, rarest, least):
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(list("abcdeFGh"), int(rng.integers(1, 30)))) for _ in range(40)] + ["", "q", "a a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality long")
    chosen = {r.doc_id for r in labels.filter("quality = 1").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).collect()}
    want = plain_losses(texts, [k in chosen for k in range(len(texts))], rarest, least)
    got = cross_entropy.cross_entropy_difference(docs, labels, rarest=rarest, least=least).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.target_loss, r.background_loss) == pytest.approx((want[0][r.doc_id], want[1][r.doc_id]))
        assert r.score == pytest.approx(r.target_loss - r.background_loss) and r.n_tokens == len(texts[r.doc_id].split())


def test_cross_entropy_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "a b", "y"), (None, "a b", "y"), (3, "", "z")], "doc_id long, text string, key string")
    labels = spark.createDataFrame([], "doc_id long, quality long")
    assert cross_entropy.cross_entropy_difference(docs, labels).count() == 4
    assert cross_entropy.cross_entropy_difference(docs.limit(0), labels).collect() == []


def test_good_documents_score_lower(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = {r.doc_id: r.score for r in cross_entropy.cross_entropy_difference(docs, labels).collect()}
    of = collections.defaultdict(list)
    for r in labels.collect():
        of[r.quality].append(got[r.doc_id])
    assert np.median(of[1]) < np.median(of[0])


@pytest.mark.parametrize("head", [0, 40])
def test_rarer_entries_are_joined(spark, monkeypatch, head):
    monkeypatch.setattr(cross_entropy, "HEAD_KEYS", head)
    test_cross_entropy(spark, cross_entropy.RAREST, 2)


def test_models_in_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(cross_entropy, "BUCKET_BYTES", 128)
    monkeypatch.setattr(cross_entropy, "HEAD_KEYS", 9)
    test_cross_entropy(spark, cross_entropy.RAREST, 2)
    test_cross_entropy_edges(spark)


def test_lists_of_a_bucket():
    buckets = np.random.default_rng(3).integers(0, 3, 4 * cross_entropy.LIST)
    of, lists = cross_entropy.by_bucket(buckets, np.arange(len(buckets)))
    held = collections.defaultdict(list)
    for b, x in zip(of.to_pylist(), lists.to_pylist()):
        part = np.frombuffer(x, np.int64).tolist()
        assert 0 < len(part) <= cross_entropy.LIST
        held[b] += part
    assert held == {b: np.flatnonzero(buckets == b).tolist() for b in range(3)}
    assert [len(x) for x in cross_entropy.by_bucket(buckets[:0], buckets[:0])] == [0, 0]


def test_models_follow_the_input(spark):
    """Words and pairs found twice count in a large table too, and so does every good document."""
    rng = np.random.default_rng(10)
    common = rng.choice([f"w{k}" for k in range(40)], (66_000, 34))
    texts = [" ".join([*row, f"rare{k // 2}", f"other{k // 2}"]) for k, row in enumerate(common)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.range(len(texts)).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, 0).otherwise(1).alias("quality"))
    chosen = {r.doc_id for r in labels.filter("quality = 1").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).collect()}
    assert len(chosen) > 50_000 and len(texts) * 36 > 2 * 2**20
    want = plain_losses(texts, [k in chosen for k in range(len(texts))], 0)
    got = cross_entropy.cross_entropy_difference(docs, labels).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    ids = [r.doc_id for r in got]
    assert np.allclose([(r.target_loss, r.background_loss) for r in got], np.array(want).T[ids])


# language


def test_visible_text_and_declaration():
    page = '<!DOCTYPE html><HTML lang="FR-be"><head><style>p{}</style><script>var t="</p>";</script></head><body><!-- no --><p>a &amp; b</p></body></html>'
    assert language.visible(page).split() == ["a", "&", "b"] and language.declared(page) == "fr"
    assert language.visible(None) == language.declared(None) == language.declared("<p lang='de'>") == ""


def test_languages_of_given_pages(spark):
    pages, docs = table(spark, SF_DIR, "pages"), table(spark, SF_DIR, "documents")
    got = language.identify(pages, docs).collect()
    assert len(got) == pages.count() and np.mean([r.lang == r.declared for r in got]) > 0.95
    assert all(0 < r.probability <= 1 for r in got)


def test_host_decides_where_the_text_is_silent(spark):
    docs = spark.createDataFrame([("the of and with this that " * 20, "en"), ("der die das und nicht ein " * 20, "de"), (None, "de"), ("x", None)], "text string, lang string")
    pages = [(k, f"https://www.haus.de/{k}", "<p>der die das und nicht ein</p>", "k") for k in range(20)]
    pages += [(100 + k, f"https://house.com/{k}", "<p>the of and with this that</p>", "k") for k in range(20)]
    pages += [(200, "https://www.haus.de/x", "<p></p>", "k"), (201, "http://house.com", None, "k"), (202, None, None, "k"), (None, "no address", "<p>the of and with</p>", "k")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = {r.page_id: r.lang for r in language.identify(frame, docs).collect()}
    assert len(got) == len(pages) and (got[200], got[201], got[None]) == ("de", "en", "en") and got[202] in ("de", "en")
    assert all(got[k] == "de" and got[100 + k] == "en" for k in range(20))
    assert language.identify(frame.limit(0), docs).collect() == []
    assert {r.lang for r in language.identify(frame, docs.limit(0)).collect()} == {None}


def plain_posterior(rows, strength=5.0):
    """rows: (host, domain, declared, suffix, like, chance) of each page."""
    n = len(rows[0][4])
    everything = np.sum([r[5] for r in rows], 0)
    sums = [collections.defaultdict(lambda: np.zeros(n)) for _ in range(4)]
    for r in rows:
        for k in range(4):
            sums[k][r[k]] += r[5]
    out = []
    for r in rows:
        def smoothed(own, towards):
            return (own + strength * towards) / (own.sum() + strength)

        own = [np.maximum(sums[k][r[k]] - r[5], 0) for k in range(4)]
        prior = smoothed(own[0], smoothed(own[1], (everything + 1) / (everything.sum() + n)))
        score = np.array(r[4]) + np.log(prior)
        for k in (2, 3):
            score += np.log((own[k] + 1) / (np.maximum(everything - r[5], 0) + len(sums[k])))
        out.append(np.exp(score - score.max()) / np.exp(score - score.max()).sum())
    return out


def test_posterior(spark):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(60):
        domain = f"d{rng.integers(0, 4)}.{rng.choice(['de', 'com'])}"
        like = -rng.random(3) * 6
        rows.append((f"{rng.choice(['a', 'b'])}.{domain}", domain, str(rng.choice(["", "de", "en"])), domain[3:], (like - like.max()).tolist(), (np.exp(like) / np.exp(like).sum())))
    frame = spark.createDataFrame([(k, *r[:4], r[4], r[5].tolist()) for k, r in enumerate(rows)], "page_id long, host string, domain string, declared string, suffix string, like array<double>, chance array<double>")
    want = plain_posterior(rows)
    names = ["de", "en", "fr"]
    for r in language.posterior(frame, names).collect():
        assert r.lang == names[int(want[r.page_id].argmax())] and r.probability == pytest.approx(want[r.page_id].max())


# pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows of each stage."""
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = table(spark, SF_DIR, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(docs.columns == columns for docs in list(stages.values())[:-1])


def test_stages_decide(spark, stages):
    from test_documents import plain_components, plain_exact

    before = table(spark, SF_DIR, "documents")
    good, unique, single, mix, packed = stages.values()
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert kept >= {i for i, y in labels.items() if y == 1} and len(kept) < before.count()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in unique.collect()} == {rows[min(g)[2]][0] for g in plain_exact(rows).values()}
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in plain_components(rows)})
    counts = collections.Counter(r.doc_id for r in mix.collect())
    assert set(counts) <= {r.doc_id for r in single.collect()} and set(counts.values()) <= {1, 2}
    tokens = collections.Counter()
    for r in packed.collect():
        tokens[r.doc_id] += r.length
    assert set(tokens) == set(counts)


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF_DIR).count() == stages["packing"].count()


def test_fit_of_neighbours_holds_the_vectors_once(monkeypatch):
    """Beside the table that came from the tasks, the driver has one copy of the term vectors and the room for a block."""
    n, rng = 3 * neighbours.BLOCK_ROWS + 7, np.random.default_rng(2)
    ids, terms = rng.permutation(n), rng.random((n, neighbours.TERMS), np.float32)
    table = pa.table({"doc_id": ids, "label": pa.array(ids % 2, pa.int32()), "terms": pa.chunked_array([pa.array([x.tobytes() for x in part], pa.binary()) for part in np.array_split(terms, 3)])})
    rows, labels = neighbours.term_rows(table)
    assert (rows == terms[np.argsort(ids)]).all() and (labels == np.arange(n) % 2).all()
    size = rows.nbytes
    del rows, labels
    sample = SimpleNamespace(mapInArrow=lambda work, schema: SimpleNamespace(toArrow=lambda: table))
    monkeypatch.setattr(neighbours, "labelled_texts", lambda *given: sample)
    tracemalloc.start()
    model = neighbours.fit(None, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.vectors) == n and model.k == 15 and peak < 3 * size
