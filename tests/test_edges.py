"""Null keys, empty frames and values that do not fit: no row is lost and no query ends."""

from pyspark.sql import functions as F

from moodgauge.functions.text import model_input
from moodgauge.operators import indices, labelling, ordering, packing
from moodgauge.streaming import stages


def test_with_previous_keeps_null_keys_and_times(spark):
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), (None, 1, 30), (None, 3, 40), ("b", None, 50)], "k string, ms bigint, v bigint")
    got = ordering.with_previous(rows, ["k"], ["ms"], ["v"], ordering.whole(F.col("ms"), 2))
    assert {r.v: r.previous and r.previous.v for r in got.collect()} == {10: None, 20: 10, 30: None, 40: 30, 50: None}


def test_length_batches_keep_null_lists(spark):
    docs = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [])], "id bigint, ids array<bigint>")
    assert {r.id for r in packing.length_batches(docs, "id").collect()} == {1, 2, 3}


def test_empty_frames(spark):
    docs = spark.createDataFrame([], "id bigint, ids array<bigint>")
    assert packing.pack(docs, "id").collect() == []
    assert packing.length_batches(docs, "id").collect() == []
    assert packing.sortish_batches(docs, "id").collect() == []
    assert ordering.number_rows(docs, "id", "n").collect() == []


def test_null_text_is_empty_for_the_model(spark):
    frame = spark.createDataFrame([(None,), ("",)], "body string")
    first, second = [r[0] for r in frame.select(model_input(F.col("body"))).collect()]
    assert first == second and first is not None


def test_an_index_that_does_not_fit_is_null(spark):
    frame = spark.createDataFrame([(1, 5.0), (2, 5e9)], "k bigint, v double")
    got = indices._rows(frame, F.col("k").cast("string"), F.lit(1), 0, F.col("v")).collect()
    assert [(r.sentiment_type, r.sentiment_absolute and float(r.sentiment_absolute)) for r in got] == [("1", 5.0), ("2", None)]


def test_unknown_labels_are_given_back(spark):
    corpus = spark.createDataFrame([("x", "Bearish"), ("y", "no such"), ("z", None), ("u", "Undetermined")], "clean_body string, sentiment string")
    assert [r.text for r in labelling.labelled_rows(corpus).collect()] == ["x"]
    assert {r.clean_body for r in labelling.unknown_label_rows(corpus).collect()} == {"y", "z"}


def test_counters_of_more_batches_than_are_reported(spark, tmp_path):
    for n in range(7):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{n}.json").write_text('{"id": "%d"}\n{"id": null}\n' % n)
    reported = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(reported)
    spark.conf.set(reported, "2")
    try:
        events = spark.readStream.schema("id string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        stages.land_counted(events, str(tmp_path / "out"), str(tmp_path / "counts"), str(tmp_path / "state")).start().awaitTermination()
    finally:
        spark.conf.set(reported, before)
    counts = spark.read.parquet(str(tmp_path / "counts"))
    assert counts.count() == 7 and tuple(counts.agg(F.sum("rows"), F.sum("keyed")).first()) == (14, 7)
