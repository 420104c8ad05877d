"""Quality rules: gradient-boosted trees over document statistics.

Each task takes the statistics of whole texts with numpy. Trees are fitted on the driver to the statistics of a bounded sample of
labelled documents (2 * `per_class`), by histograms of each statistic and second-order gains. Statistics in `FALLING` may only lower
the verdict: a split on one must not give its upper side more than its lower side, and both sides' later values are kept on their side
of the middle. The trees are complete and flattened into arrays (feature, threshold, value), so scoring is one comparison per level for all rows.

Defined cases: a null or empty text has all statistics 0, and fails the base rules; without labelled rows of both kinds the base
rules alone decide; rows that repeat and further columns have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from moodgauge.llm import text as tx
from moodgauge.llm.labelled import labelled_texts

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbol_rate", "dup_line_share", "repeat_share", "upper_share", "digit_share", "sign_share", "distinct_share", "words_per_line", "wide_share")
FALLING = ("symbol_rate", "dup_line_share", "repeat_share")
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass
class Trees:
    """Complete trees of one depth: node k's children are 2 * k + 1 and 2 * k + 2; values stand at the last level."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def logit(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.start)
        inner, place = self.feature.shape[1], np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(rows), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (rows[place, feature[node]] > threshold[node])
            out += value[node - inner]
        return out


def count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many are set in each text."""
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return np.diff(running[offsets])


def same_before(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item whether its value occurs at least twice in its group, and whether it did earlier."""
    order = np.lexsort((np.arange(len(values)), values, group))
    v, g = values[order], group[order]
    equal = (v[1:] == v[:-1]) & (g[1:] == g[:-1])
    again, twice = np.zeros(len(values), bool), np.zeros(len(values), bool)
    again[order] = np.append(False, equal)[: len(values)]
    twice[order] = (np.append(False, equal) | np.append(equal, False))[: len(values)]
    return twice, again


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The columns of BASE, and those of FEATURES."""
    texts = np.arange(len(offsets) - 1)
    solid = ~tx.SPACE[data]
    begin, end, at = tx.words(data, offsets)
    counts = np.diff(at)
    running = tx.sums(data)
    hashes = tx.span_hash(running, begin, end)
    n_words, word_chars, n_symbols = counts, count(solid & ((data & 0xC0) != 0x80), offsets), count(SYMBOLS[data], offsets)
    l_begin, l_end, _ = tx.lines(data, offsets)
    solid_before = np.append(0, np.cumsum(solid))
    spoken = solid_before[l_end] > solid_before[l_begin]
    l_begin, l_end = l_begin[spoken], l_end[spoken]
    line_text = np.searchsorted(offsets, l_begin, "right") - 1
    _, again = same_before(tx.span_hash(running, l_begin, l_end), line_text)
    n_lines, n_dup_lines = np.bincount(line_text, minlength=len(texts)), np.bincount(line_text, again, len(texts)).astype(np.int64)
    places, of = tx.whole_windows(counts, 3)
    twice, _ = same_before(tx.grams(hashes, 3)[places], of)
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, places[twice], 1)
    np.add.at(edge, places[twice] + 3, -1)
    n_repeat_words = count(np.cumsum(edge)[:-1] > 0, at)
    word_text = np.repeat(texts, counts)
    _, known = same_before(hashes, word_text)
    distinct = counts - np.bincount(word_text, known, len(texts))
    some, chars, size = np.maximum(counts, 1), np.maximum(word_chars, 1), np.maximum(np.diff(offsets), 1)
    upper, digit = count((data >= 65) & (data <= 90), offsets), count((data >= 48) & (data <= 57), offsets)
    sign = count((data > 32) & (data < 127), offsets) - upper - digit - count((data >= 97) & (data <= 122), offsets)
    base = np.stack((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), 1).astype(np.int64)
    features = (np.log2(counts + 1), word_chars / some, n_symbols / some, n_dup_lines / np.maximum(n_lines, 1), n_repeat_words / some, upper / chars, digit / chars, sign / chars, distinct / some, counts / np.maximum(n_lines, 1), count(data >= 128, offsets) / size)
    return base, np.stack(features, 1).astype(np.float64)


def fit_trees(rows: np.ndarray, labels: np.ndarray, falling: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, penalty: float = 1.0) -> Trees:
    """Boosted trees for the log-odds of label 1, never rising in the features `falling`."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, rows.T)], 1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    logit, inner = np.full(len(rows), start), 2**depth - 1
    out = Trees(start, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        chance = 1 / (1 + np.exp(-logit))
        slope, bend = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        for k in range(inner):
            own = np.flatnonzero(node == k)
            best = None
            if len(own):
                for f, edge in enumerate(edges):
                    g = np.bincount(binned[own, f], slope[own], len(edge) + 1).cumsum()
                    h = np.bincount(binned[own, f], bend[own], len(edge) + 1).cumsum()
                    left_g, left_h, right_g, right_h = g[:-1], h[:-1], g[-1] - g[:-1], h[-1] - h[:-1]
                    left, right = (np.clip(-a / (b + penalty), low[k], high[k]) for a, b in ((left_g, left_h), (right_g, right_h)))
                    # second-order loss of the clipped values
                    gain = -(left_g * left + (left_h + penalty) * left**2 / 2) - (right_g * right + (right_h + penalty) * right**2 / 2)
                    gain[(left_h < 1e-2) | (right_h < 1e-2)] = -np.inf
                    if f in falling:
                        gain[right > left] = -np.inf
                    if len(gain) and (best is None or gain.max() > best[0]):
                        j = int(gain.argmax())
                        best = (gain[j], f, edge[j], left[j], right[j])
            low[2 * k + 1] = low[2 * k + 2] = low[k]
            high[2 * k + 1] = high[2 * k + 2] = high[k]
            if best is not None and np.isfinite(best[0]):
                _, f, threshold, left, right = best
                out.feature[t, k], out.threshold[t, k] = f, threshold
                if f in falling:
                    low[2 * k + 1] = high[2 * k + 2] = (left + right) / 2
                node[own] = 2 * k + 1 + (rows[own, f] > threshold)
            else:
                node[own] = 2 * k + 1
        for leaf in range(inner + 1):
            own = node == inner + leaf
            # a leaf without rows may get a value other than 0 from its bounds, which keeps the order
            value = -slope[own].sum() / (bend[own].sum() + penalty)
            out.value[t, leaf] = rate * np.clip(value, low[inner + leaf], high[inner + leaf])
        logit += out.value[t][node - inner]
    return out


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = 4000, **options) -> Trees | None:
    """Trees over the statistics of at most 2 * per_class labelled documents; None if a label is missing."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                features = statistics(data, offsets)[1]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").cast(pa.int64()), rows.column("label").cast(pa.int32()), pa.array(features.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "features"])

    held = labelled_texts(docs, labels, column, per_class).mapInArrow(tx.tidy(measure), "doc_id long, label int, features array<double>").toArrow().sort_by("doc_id")
    known = held["label"].to_numpy()
    if len(set(known.tolist())) < 2:
        return None
    return fit_trees(np.array(held["features"].to_pylist()), known.astype(float), [FEATURES.index(f) for f in FALLING], **options)


def judged(docs: DataFrame, trees: Trees | None, threshold: float = 0.3) -> DataFrame:
    """doc_id, the columns of BASE, base_failed, chance and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in BASE) + ", base_failed boolean, chance double, kept boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                base, features = statistics(data, offsets)
                failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
                chance = 1 / (1 + np.exp(-shared.value.logit(features))) if shared.value else np.full(len(base), 0.5)
                arrays = [rows.column("doc_id").cast(pa.int64()), *map(pa.array, base.T.copy()), pa.array(failed), pa.array(chance), pa.array(~failed & (chance >= threshold))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *BASE, "base_failed", "chance", "kept"])

    return docs.select("doc_id", "text").mapInArrow(tx.tidy(judge), schema)


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and the trees' chance for every document."""
    return judged(docs, fit(docs, labels, **options))
