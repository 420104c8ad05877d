"""Toxicity from subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5 bytes, with marks for its ends) and itself, hashed into `BUCKETS` vectors. The
mean vector of the bag goes into a softmax over clean and toxic; as an unseen misspelling shares most n-grams, it shares most of the
vector. Labels are known per document only: a document is toxic if at least one of its words is (noisy-or), so that training finds
the words that tell; a document's score is that of its most toxic word, so a long text does not dilute one insult. After a first
round, misspelt variants of the words found, and of clean words, are added as examples of their kind.

The sample is bounded (2 * `per_class` labelled documents, as their distinct words). The model has a fixed size. Scoring looks at
each distinct word of a chunk once.

Defined cases: null and empty texts have no word and score `EMPTY_SCORE`; without labelled rows of both kinds every score is that;
rows that repeat and further columns have no effect.
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

BUCKETS, WIDTH = 1 << 18, 16
SIZES = (3, 4, 5)
TEMPERATURE = 10.0
EMPTY_SCORE = 0.0
LETTERS, LOOKALIKES = np.arange(97, 123), np.frombuffer(b"0134578@$*", np.uint8)
APART = tx.SPACE.copy()
APART[[ord(c) for c in '.,;:!?"()[]{}|<>/\\']] = True


@dataclass
class Model:
    """Of vectors and softmax only their product is needed for scores: one number per bucket."""

    lean: np.ndarray
    bias: float


def bags(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the n-grams of each word, end to end, and where each word's begin (one more at the end)."""
    size = end - begin
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + 2, out=at[1:])
    marked = np.full(int(at[-1]), ord(">"), np.uint8)
    marked[at[:-1]] = ord("<")
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    marked[inner + np.repeat(at[:-1] + 1, size)] = data[inner + np.repeat(begin, size)]
    running = tx.sums(marked)
    word = np.repeat(np.arange(len(size)), size + 2)
    place = np.arange(len(marked))
    found, of = [tx.span_hash(running, at[:-1], at[1:])], [np.arange(len(size))]
    for n in SIZES:
        whole = place[place + n <= at[word + 1]]
        found.append(tx.span_hash(running, whole, whole + n))
        of.append(word[whole])
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(BUCKETS)).astype(np.int32), np.searchsorted(of[order], np.arange(len(size) + 1))


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Lowered bytes; begin and end of each distinct word; for each word of the texts its distinct word; words before each text."""
    lowered = tx.LOWER[data]
    begin, end = tx.spans(~APART[data], offsets)
    _, first, which = np.unique(tx.span_hash(tx.sums(lowered), begin, end), return_index=True, return_inverse=True)
    return lowered, begin[first], end[first], which, np.searchsorted(begin, offsets)


def leaning(lean: np.ndarray, bias: float, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The logit of each bag."""
    if len(at) < 2:
        return np.zeros(0)
    return bias + TEMPERATURE * np.add.reduceat(lean[buckets].astype(np.float64), at[:-1]) / np.diff(at)


class Trainer:
    """Vectors and softmax with AdaGrad steps."""

    def __init__(self, rng: np.random.Generator):
        self.vectors = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
        self.softmax = rng.normal(0, 0.3, (2, WIDTH)).astype(np.float32)  # clean, toxic
        self.bias = -7.0
        self.seen_vectors, self.seen_softmax, self.seen_bias = np.full(BUCKETS, 1e-3, np.float32), np.full((2, WIDTH), 1e-3, np.float32), 1e-3

    def lean(self) -> np.ndarray:
        return self.vectors @ (self.softmax[1] - self.softmax[0])

    def step(self, buckets: np.ndarray, at: np.ndarray, slope: np.ndarray, rate: float) -> None:
        """slope: the loss by each bag's logit."""
        size = np.diff(at)
        pull = np.bincount(buckets, np.repeat(slope * TEMPERATURE / size, size), BUCKETS)
        touched = np.flatnonzero(pull)
        pull = pull[touched].astype(np.float32)
        apart = self.softmax[1] - self.softmax[0]
        of_softmax = pull @ self.vectors[touched]
        of_softmax = np.stack((-of_softmax, of_softmax))
        self.seen_vectors[touched] += (pull * np.linalg.norm(apart)) ** 2
        self.vectors[touched] -= rate * pull[:, None] * apart / np.sqrt(self.seen_vectors[touched])[:, None]
        self.seen_softmax += of_softmax**2
        self.softmax -= rate * of_softmax / np.sqrt(self.seen_softmax)
        total = float(slope.sum())
        self.seen_bias += total**2
        self.bias -= rate * total / np.sqrt(self.seen_bias)


def part(buckets: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bags of the chosen words."""
    size = np.diff(at)[chosen]
    upto = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=upto[1:])
    return buckets[np.arange(upto[-1]) + np.repeat(at[:-1][chosen] - upto[:-1], size)], upto


def misspelt(words: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """For each word of 5 bytes or more: with one byte left out, doubled, swapped with the next, and replaced by a letter or a sign."""
    out = []
    for word in words:
        if len(word) >= 5:
            k = int(rng.integers(1, len(word) - 1))
            out += [word[:k] + word[k + 1 :], word[:k] + word[k : k + 1] + word[k:], word[:k] + word[k + 1 : k + 2] + word[k : k + 1] + word[k + 2 :]]
            out += [word[:k] + bytes([int(rng.choice(signs))]) + word[k + 1 :] for signs in (LETTERS, LOOKALIKES)]
    return out


def bags_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return bags(data, end - [len(w) for w in words], end)


def train(texts: list[np.ndarray], labels: np.ndarray, words: list[bytes], epochs: int, rate: float, batch: int) -> Model:
    """texts: the words of each document, as places in `words`."""
    rng = np.random.default_rng(5)
    buckets, at = bags_of(words)
    own = Trainer(rng)

    def documents(rounds: int) -> None:
        for _ in range(rounds):
            order = rng.permutation(len(texts))
            for some in (order[k : k + batch] for k in range(0, len(order), batch)):
                rows = [texts[i] for i in some]
                size = np.array([len(r) for r in rows])
                which, back = np.unique(np.concatenate(rows), return_inverse=True)
                bag, starts = part(buckets, at, which)
                logit = leaning(own.lean(), own.bias, bag, starts)
                toxic = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                total = np.add.reduceat(np.logaddexp(0, logit)[back], np.cumsum(size) - size)
                by_total = np.where(labels[some] == 1, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0) / len(some)
                slope = np.bincount(back, np.repeat(by_total, size) * toxic[back], len(which))
                own.step(bag, starts, slope, rate)

    documents(epochs)
    clean_words = np.unique(np.concatenate([texts[i] for i in np.flatnonzero(labels == 0)]))
    is_clean = np.zeros(len(words), bool)
    is_clean[clean_words] = True
    logit = leaning(own.lean(), own.bias, buckets, at)
    found = [words[k] for k in np.flatnonzero((logit > 0) & ~is_clean)]
    variants = [v for _ in range(4) for v in misspelt(found, rng)]
    known = {words[k] for k in clean_words}
    variants = [v for v in dict.fromkeys(variants) if v not in known]
    if variants:
        bad, bad_at = bags_of(variants)
        for _ in range(epochs):
            picked = rng.choice(clean_words, min(len(clean_words), 20 * len(variants)), replace=False)
            good, good_at = part(buckets, at, picked)
            bag, starts = np.concatenate((bad, good)), np.concatenate((bad_at, good_at[1:] + bad_at[-1]))
            toxic = 1 / (1 + np.exp(-np.clip(leaning(own.lean(), own.bias, bag, starts), -30, 30)))
            goal = np.arange(len(toxic)) < len(variants)
            own.step(bag, starts, (toxic - goal) * np.where(goal, 1.0, 4.0) / len(variants), rate)
            documents(1)
    return Model(own.lean().astype(np.float32), own.bias)


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = 2000, epochs: int = 12, rate: float = 0.3, batch: int = 64) -> Model | None:
    """The model of at most 2 * per_class labelled documents; None if a label is missing."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, data, offsets in tx.chunks(b, "text"):
                lowered, begin, end, which, at = distinct_words(data, offsets)
                raw = lowered.tobytes()
                table = pa.array([raw[x:y] for x, y in zip(begin.tolist(), end.tolist())], pa.binary())
                for k in range(rows.num_rows):
                    own = table.take(pa.array(np.unique(which[at[k] : at[k + 1]])))
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id").slice(k, 1).cast(pa.int64()), rows.column("label").slice(k, 1).cast(pa.int32()), pa.array([own], pa.list_(pa.binary()))], ["doc_id", "label", "words"])

    held = labelled_texts(docs, labels, column, per_class).mapInArrow(tx.tidy(words), "doc_id long, label int, words array<binary>").toArrow()
    held = held.filter(pa.compute.greater(pa.compute.list_value_length(held["words"]), 0)).sort_by("doc_id")
    labels_of = held["label"].to_numpy()
    if len(set(labels_of.tolist())) < 2:
        return None
    flat = pa.compute.list_flatten(held["words"]).combine_chunks().dictionary_encode()
    upto = np.cumsum(pa.compute.list_value_length(held["words"]).to_numpy())
    texts = np.split(flat.indices.to_numpy(), upto[:-1])
    return train(texts, labels_of, flat.dictionary.to_pylist(), epochs, rate, batch)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of the documents and `toxicity`, in place of a column of that name."""
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            for rows, data, offsets in tx.chunks(b, "text"):
                out = np.full(rows.num_rows, EMPTY_SCORE)
                if own is not None:
                    lowered, begin, end, which, at = distinct_words(data, offsets)
                    logit = leaning(own.lean, own.bias, *bags(lowered, begin, end))
                    some = np.flatnonzero(np.diff(at) > 0)
                    if len(some):
                        out[some] = 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(logit[which], at[:-1][some]), -30, 30)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out)], [*rows.schema.names, "added"])

    return mapped_rows(docs, tx.tidy(score), "toxicity")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, **options))
    return out.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= threshold).cast("int").alias("predicted"))
