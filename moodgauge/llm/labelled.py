"""Labelled rows, and bounded samples of them, from which the classifiers of this folder learn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm.tables import held_out


def label_rows(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of all rows labelled 0 or 1, none of them held out.

    Null ids and labels are left out; an id with several labels counts once, with the largest.
    """
    rows = labels.filter(~held_out()).filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    return rows.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))


def label_sample(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(doc_id, label) of at most `per_class` rows of each label 0 and 1, none of them held out.

    The rows with the smallest hash of their id are taken, so that reruns agree. Null ids and labels are left out; an id with
    several labels counts once, with the largest.
    """
    rows = label_rows(labels, column)
    order = [F.xxhash64("doc_id"), "doc_id"]
    of = [rows.filter(F.col("label") == value).orderBy(*order).limit(per_class) for value in (0, 1)]
    return of[0].unionByName(of[1])


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(doc_id, text, label) of the sample; it has at most 2 * per_class ids, so it is broadcast, and only their texts are shuffled.

    An id that several rows have counts once, with the smallest text.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(label_sample(labels, column, per_class)), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
