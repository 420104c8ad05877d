"""Quality by nearest-neighbour voting over latent-semantic vectors.

Fit: term vectors of a bounded, class-balanced sample of labelled documents (at most 2 * `per_class`), weighted by inverse
document frequency, and a randomised singular value decomposition on the driver. The projection and the labelled vectors have a
fixed size (`TERMS` x `rank` and 2 * `per_class` x `rank`), so they are broadcast. Score: each task computes exact cosine
products of its documents with all labelled vectors, block by block, and lets the `k` nearest vote with similarity weights.

Defined cases: null and empty texts have no term but the one for their length, and are scored by it; without any labelled row, every
score is 0.5; rows repeat, and further columns pass or are ignored, without effect on a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.labelled import labelled_texts
from moodgauge.llm.tables import held_out, mapped_rows

WORD_TERMS, SHAPE_TERMS, END_TERMS, RATE_TERMS = 2048, 192, 128, 96
TERMS = WORD_TERMS + SHAPE_TERMS + END_TERMS + RATE_TERMS
BLOCK_ROWS = 1024


@dataclass
class Model:
    weights: np.ndarray  # by term
    projection: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled rows x rank, of length 1
    labels: np.ndarray
    k: int
    sharpness: float


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Terms of each text: hashed words, word shapes, last characters, and rates of the text in bins."""
    n = len(offsets) - 1
    begin, end, at = tx.words(data, offsets)
    counts = np.diff(at)
    doc = np.repeat(np.arange(n), counts)
    hashes = tx.span_hash(tx.sums(tx.LOWER[data]), begin, end)
    kinds = {"upper": (data >= 65) & (data <= 90), "digit": (data >= 48) & (data <= 57), "wide": data >= 128}
    kinds["sign"] = (data > 32) & (data < 127) & ~kinds["upper"] & ~kinds["digit"] & ~((data >= 97) & (data <= 122))
    of = {}
    for name, is_kind in kinds.items():
        running = np.zeros(len(data) + 1, np.int32)
        np.cumsum(is_kind, out=running[1:], dtype=np.int32)
        of[name] = running[end] - running[begin]
    size = end - begin
    upper = np.where(of["upper"] == 0, 0, np.where(of["upper"] == 1, 1, 2))
    length = np.digitize(size, (3, 6, 10))
    shape = (((upper * 2 + (of["digit"] > 0)) * 4 + np.minimum(of["sign"], 3)) * 4 + length) * 2 + (of["wide"] > 0)
    last = data[end - 1] & 127 if len(end) else np.zeros(0, np.uint8)
    out = np.empty((n, TERMS), np.float32)

    def count(terms, room):
        return np.bincount(doc * room + terms.astype(np.int64), minlength=n * room).reshape(n, room)

    part = count(hashes % np.uint64(WORD_TERMS), WORD_TERMS)
    used, most = (part > 0).sum(1), part.max(1, initial=0)
    out[:, :WORD_TERMS] = np.log1p(part)
    at_shape = WORD_TERMS + SHAPE_TERMS
    out[:, WORD_TERMS:at_shape] = count(shape, SHAPE_TERMS)
    out[:, at_shape : at_shape + END_TERMS] = count(last, END_TERMS)
    again = np.zeros(len(hashes), bool)
    for back in (1, 2, 3):
        again[back:] |= (hashes[back:] == hashes[:-back]) & (doc[back:] == doc[:-back])
    some = np.maximum(counts, 1)
    rates = np.zeros((n, RATE_TERMS), np.float32)
    for k, rate in enumerate((used / np.minimum(some, 400), most / some, np.bincount(doc, again, n) / some, np.bincount(doc, of["sign"], n) / some / 4, np.bincount(doc, size, n) / some / 16)):
        # every bin up to the rate, so that near rates are near vectors
        rates[:, 15 * k : 15 * k + 15] = np.arange(15) / 15 <= rate[:, None]
    rates[np.arange(n), 75 + np.minimum(np.log2(counts + 1).astype(int), 20)] = 1
    out[:, -RATE_TERMS:] = rates
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-9)


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each kind of terms with weights and of length 1, so that no kind drowns another."""
    out, at = np.empty_like(counts), 0
    for room, share in ((WORD_TERMS, 0.7), (SHAPE_TERMS, 1.0), (END_TERMS, 1.0), (RATE_TERMS, 1.5)):
        out[:, at : at + room] = unit(counts[:, at : at + room] * weights[at : at + room]) * share
        at += room
    return out


def term_rows(held: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Term vectors and labels by doc_id, which is unique. The vectors are the one copy beside the table: the driver has few MB."""
    place = np.empty(held.num_rows, np.int64)
    place[np.argsort(held["doc_id"].to_numpy())] = np.arange(held.num_rows)
    rows, labels = np.empty((held.num_rows, TERMS), np.float32), np.empty(held.num_rows, np.float32)
    labels[place] = held["label"].to_numpy()
    at = 0
    for chunk in held["terms"].chunks:
        for k in range(0, len(chunk), BLOCK_ROWS):
            part = chunk.slice(k, BLOCK_ROWS).to_pylist()
            rows[place[at : at + len(part)]] = np.frombuffer(b"".join(part), np.float32).reshape(len(part), TERMS)
            at += len(part)
    return rows, labels


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = 2500, rank: int = 64, k: int = 15, sharpness: float = 4.0) -> Model | None:
    """The latent-semantic vectors of at most 2 * per_class labelled documents; None if there is none."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", most_rows=BLOCK_ROWS):
                counts = term_counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()), rows.column("label").cast(pa.int32()), pa.array([x.tobytes() for x in counts], pa.binary())], ["doc_id", "label", "terms"]
                )

    sample = labelled_texts(docs, labels, column, per_class).mapInArrow(tx.tidy(vectors), "doc_id long, label int, terms binary")
    held = sample.toArrow()
    if held.num_rows == 0:
        return None
    rows, labels_of = term_rows(held)
    del held
    blocks = [rows[at : at + BLOCK_ROWS] for at in range(0, len(rows), BLOCK_ROWS)]
    known = sum((block > 0).sum(0) for block in blocks)
    weights = np.log((len(rows) + 1) / (known + 1)).astype(np.float32) + 0.1
    for block in blocks:
        block[:] = weighted(block, weights)
    rank = min(rank, len(rows), TERMS)
    basis = np.linalg.qr(rows.T @ (rows @ np.random.default_rng(1).standard_normal((TERMS, rank + 16), np.float32)))[0]
    for _ in range(3):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    projection = np.ascontiguousarray((basis @ right.T)[:, :rank], np.float32)
    return Model(weights, projection, unit(rows @ projection), labels_of, min(k, len(rows)), sharpness)


def vote(model: Model, counts: np.ndarray) -> np.ndarray:
    """Scores from 0 to 1 for rows of term counts."""
    near = unit(weighted(counts, model.weights) @ model.projection) @ model.vectors.T
    best = np.argpartition(-near, model.k - 1, axis=1)[:, : model.k]
    weight = np.maximum(np.take_along_axis(near, best, 1), 1e-3) ** model.sharpness
    return np.clip((weight * model.labels[best]).sum(1) / weight.sum(1), 0, 1)


def scored(docs: DataFrame, model: Model | None, keep_from: float | None = None) -> DataFrame:
    """All columns of the documents and `quality_score`, in place of a column of that name; with `keep_from`, the rows that reach it as they are."""
    docs = docs if keep_from is not None else docs.drop("quality_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", most_rows=BLOCK_ROWS):
                of = np.full(rows.num_rows, 0.5) if shared.value is None else vote(shared.value, term_counts(data, offsets)).astype(np.float64)
                if keep_from is None:
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(of)], [*rows.schema.names, "added"])
                else:
                    yield rows.filter(pa.array(of >= keep_from))

    return mapped_rows(docs, tx.tidy(score), None if keep_from is not None else "quality_score")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit(docs, labels, **options)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).cast("int").alias("predicted")
    )


def good_only(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    return scored(docs, fit(docs, labels, **options), threshold)
