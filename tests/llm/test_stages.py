"""The pipeline's stages on tables with clashing column names, derived inputs, very long texts, and repeated labelled rows."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from moodgauge.llm import exact, jaccard, labelled, mixing, neighbours, packing, subwords

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

# every working name of the stages, and the name of Spark's own column of a scan
NAMES = [
    "quality_score", "terms", "label", "gone", "__locator", "locator", "place", "row", "digest", "body", "first", "hits", "bucket", "bitmap", "byte", "bit", "n", "__row", "node",
    "size", "component", "mix_size", "mix_copies", "mix_source_size", "mix_target", "__mix_key", "__mix_size", "__mix_source", "__mix_cut", "__mix_copy", "name", "key", "toxicity",
    "_metadata", "col", "start", "ids", "a.b",
]
GOOD = "the people of the town met in the hall and spoke of the road they were to build that year before winter came "
ROWS = [(k, GOOD + f"number {k} " * 20, "s1") for k in range(12)] + [(12, GOOD + "number 3 " * 20, "s2"), (13, GOOD + "number 3 " * 20, None), (14, None, "s1"), (15, "", "s1"), (None, GOOD, "s2"), (3, GOOD + "number 3 " * 20, "s1")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return rows.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    docs.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(12)], "doc_id long, quality long, toxic long")


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


STAGES = {
    "good_only": lambda docs, labels: neighbours.good_only(docs, labels, per_class=5),
    "without_copies": lambda docs, labels: exact.without_copies(docs),
    "one_of_each": lambda docs, labels: jaccard.one_of_each(docs),
    "mixed_rows": lambda docs, labels: mixing.mixed_rows(docs),
}


@pytest.mark.parametrize("name", STAGES)
def test_clashing_names_and_derived_inputs(stored, labels, name):
    stage = STAGES[name]
    bare = plain(stage(stored.select("doc_id", "text", "source"), labels))
    assert bare and len(bare) <= 2 * len(ROWS)
    for given in (stored, stored.filter("doc_id IS NULL OR doc_id >= 0").select("*")):
        out = stage(given, labels)
        assert out.columns == given.columns
        rows = out.select("doc_id", "text", "source", *[f"`{n}`" for n in NAMES])
        if name in ("good_only", "mixed_rows"):  # the other two choose a row of equal ids by its place
            assert plain(rows.select("doc_id", "text", "source")) == bare
        else:
            assert len(plain(rows)) == len(bare)
        for row in rows.collect():
            assert all(row[n] == (None if row.doc_id is None else f"{n}:{row.doc_id}") for n in NAMES)


def test_scores_replace_a_column_of_their_name(stored, labels):
    model = subwords.fit(stored, labels, per_class=5)
    scored = subwords.scored(stored, model)
    assert sorted(scored.columns) == sorted(stored.columns) and dict(scored.dtypes)["toxicity"] == "double"
    scored = neighbours.scored(stored, neighbours.fit(stored, labels, per_class=5))
    assert sorted(scored.columns) == sorted(stored.columns) and dict(scored.dtypes)["quality_score"] == "double"
    assert packing.packed(stored).filter("doc_id = 3").select("doc_id").distinct().count() == 1


def test_a_labelled_id_of_many_rows_counts_once(spark):
    docs = spark.range(1000).selectExpr("2L as doc_id", "concat('text ', id) as text").unionAll(spark.createDataFrame([(1, "one"), (4, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(k, 1, 0) for k in (1, 2, 4)], "doc_id long, quality long, toxic long")
    got = {r.doc_id: r.text for r in labelled.labelled_texts(docs, labels, "quality", 10).collect()}
    assert {k: v for k, v in {1: "one", 2: "text 0", 4: None}.items() if k in got} == got and 2 in got


def test_a_state_that_is_kept_goes_on_as_the_table_grows(spark, tmp_path):
    path, state = str(tmp_path / "documents.parquet"), str(tmp_path / "state")
    parts = [[(5, "a b"), (6, "c"), (7, "a  b")], [(1, "a\tb"), (8, "c"), (9, "d"), (None, "d")], []]
    seen = []
    for part in parts:
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
        seen += part
        docs = spark.read.parquet(path)
        for options in ({"state_dir": state}, {"state_dir": state, "digest": exact.sha256}, {}):
            groups = exact.exact_groups(docs, **options).select("doc_id", "keep_id", "group_size")
            equal = {}
            for k, text in seen:
                equal.setdefault(" ".join(text.split()), []).append(k)
            want = [(k, min((x for x in own if x is not None), default=None), len(own)) for own in equal.values() for k in own]
            assert plain(groups) == sorted(want, key=str)
    records = spark.read.schema(exact.RECORDS).parquet(f"{state}/records")
    assert records.count() == len(seen) == records.select("locator").distinct().count()


def test_the_bitmap_keeps_every_hit_and_few_others(spark):
    rows = spark.range(5000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), "id")
    kept = [r.id for r in exact.may_be_hit(rows, rows.filter("id % 10 = 3").select("digest")).collect()]
    assert {k for k in kept if k % 10 == 3} == set(range(3, 5000, 10)) and len(kept) < 520


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_a_very_long_text(spark, tmp_path, name):
    long = " ".join(f"{k} {GOOD}" for k in range(75_000))
    assert len(long) > 8_000_000
    path = str(tmp_path / "documents.parquet")
    rows = [(1, long, "en", "s"), (2, long, "en", "s"), (3, GOOD * 3, "en", "s"), (4, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(1).write.parquet(path)
    spark.createDataFrame([(k, 1, 0) for k in range(4)], "doc_id long, quality long, toxic long").write.parquet(str(tmp_path / "labels.parquet"))
    out = dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(path), str(tmp_path))
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert ids == {"quality_classifier": {1, 2, 3, 4}, "exact_dedup": {1, 3, 4}, "jaccard_join": {1, 3, 4}, "source_mix": {1, 2, 3}, "packing": {1, 2, 3, 4}}[name] or name in ("quality_classifier", "source_mix")
    assert 1 in ids or 2 in ids


def test_empty_tables_go_through_all_stages(spark, tmp_path):
    for rows in ([], [(1, None, None, None), (None, "", "en", "s")]):
        folder = tmp_path / str(len(rows))
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(str(folder / "labels.parquet"))
        # of texts without words at most the end ids are packed
        assert corpus_pipeline.run(spark, str(folder)).filter("length > 1").count() == 0
