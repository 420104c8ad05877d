"""Ranked lexical search by the Best Position Algorithm over impact lists.

Each document is read once: its number of terms, and how often each term of the items is found in it, compared byte by byte. From these
come the corpus figures (documents, terms, documents per term). The documents are then indexed where they lie, in shards of bounded
size: per term a list of (impact, document), highest impact first, and the place of each document in it for direct access.

An item reads its terms' lists in parallel, a block at a time. Each document met for the first time is looked up in all lists, which
gives its whole score and marks its places there as seen. The best position of a list is the end of its seen places without a gap: no
unseen document can have more from this list than the place after it holds. The sum of these is the threshold; the search ends when it is
strictly below the k-th score so far, so an unseen document can't even tie. Reading goes on after the best position. The scores of one
shard are the start for the next one of the same task; a task gives its k best, which are merged in two levels.

Items are worked on in groups whose terms fit a broadcast of bounded size, one after another.

Defined cases: a null text, of a document or an item, has no terms, is not counted and is never found; rows of one item_id are one item
with all their terms, rows of a null item_id as well; documents that repeat rank each; a null doc_id comes after all others of equal
score; further columns are ignored; without documents or items the result is empty. A task holds a chunk of about 2 MB of text, or one
longer text, at some 30 bytes a byte, and a shard of POSTINGS places at some 60 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.tables import drop, stored

BEST = 50
POSTINGS = 1 << 21
ITEM_TERMS = 1 << 18
BLOCK = 64
MOST_BLOCK = 1 << 13
MERGED_TASKS = 256
LONG_TERM = 48
NO_ID = np.iinfo(np.int64).max

# digits, ASCII letters, and all bytes of other letters and signs
TERM = np.zeros(256, bool)
TERM[0x30:0x3A] = TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True
MATCHED = "doc_id long, n long, terms array<int>, times array<int>"
RESULT = "part int, item int, score long, no_id boolean, doc_id long"


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z lowered, begin and end of each term, and how many lie before each text."""
    lowered = tx.LOWER[data]
    begin, end = tx.spans(TERM[lowered], offsets)
    return lowered, begin, end, np.searchsorted(begin, offsets)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                lowered, begin, end, at = terms_of(data, offsets)
                raw = lowered.tobytes()
                terms = pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()).cast(pa.string())
                item = rows.column("item_id").take(pa.array(np.repeat(np.arange(rows.num_rows), np.diff(at))))
                yield pa.RecordBatch.from_arrays([item, terms], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", F.col("text").cast("string")).mapInArrow(tx.tidy(give), f"item_id {kind}, term string").distinct()


class Terms:
    """Finds terms of a list among spans of bytes."""

    def __init__(self, terms: list[bytes]):
        lengths = np.array([len(t) for t in terms], np.int64)
        self.begin = np.cumsum(lengths) - lengths
        self.lengths, self.data = lengths, np.frombuffer(b"".join(terms), np.uint8)
        hashes = tx.span_hash(tx.sums(self.data), self.begin, self.begin + lengths) if terms else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.alike = int(np.unique(hashes, return_counts=True)[1].max(initial=1))

    def equal(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Whether each span has the bytes of the term."""
        own, start = self.lengths[term], self.begin[term]
        same = own == end - begin
        short = same & (own <= LONG_TERM)
        for k in range(int(own[short].max(initial=0))):
            at = np.flatnonzero(short & same & (own > k))
            same[at] = data[begin[at] + k] == self.data[start[at] + k]
        for k in np.flatnonzero(same & (own > LONG_TERM)):
            same[k] = np.array_equal(data[begin[k] : end[k]], self.data[start[k] : start[k] + own[k]])
        return same

    def find(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of each span's term in the list, or -1. Hashes only tell where to compare bytes."""
        hashes = tx.span_hash(tx.sums(data), begin, end)
        spot = np.searchsorted(self.hashes, hashes)
        out = np.full(len(begin), -1, np.int64)
        for _ in range(self.alike):
            at = np.flatnonzero((out < 0) & (spot < len(self.hashes)))
            at = at[self.hashes[spot[at]] == hashes[at]]
            term = self.order[spot[at]]
            same = self.equal(data, begin[at], end[at], term)
            out[at[same]] = term[same]
            spot += 1
        return out


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values.astype(np.int32)))


def matched(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """A row per document with a term of any kind: doc_id, its number of terms, its places in `terms`, and how often it has each."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(shared.value)
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                lowered, begin, end, at = terms_of(data, offsets)
                n = np.diff(at)
                text, term = np.repeat(np.arange(rows.num_rows), n), known.find(lowered, begin, end)
                pair, times = np.unique((text << 32 | term)[term >= 0], return_counts=True)
                some = np.flatnonzero(n)
                counts = np.bincount(pair >> 32, minlength=rows.num_rows)[some]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(some)), pa.array(n[some]), lists(pair & 0xFFFFFFFF, counts), lists(times, counts)], ["doc_id", "n", "terms", "times"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tx.tidy(give), MATCHED)


def document_counts(rows: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term. Tasks sum their own documents; at most a row per term reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            held += np.bincount(pc.list_flatten(batch.column("terms")).to_numpy(zero_copy_only=False), minlength=terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "n"])

    sums = rows.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(terms, np.int64)
    out[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return out


def weights(n_docs: int, counts: np.ndarray) -> np.ndarray:
    return np.array([floor(1000 * log((2 * n_docs + 2) / (2 * df + 1))) for df in counts.tolist()], np.int64)


class Shard:
    """Impact lists of some documents, in the order of their ids."""

    def __init__(self, ids: np.ndarray, size: np.ndarray, counts: np.ndarray, terms: np.ndarray, times: np.ndarray, weight: np.ndarray):
        """size: m of each document; counts: its number of places in terms and times; weight: of each term."""
        self.ids = ids
        row, times = np.repeat(np.arange(len(ids)), counts), times.astype(np.int64)
        impact = weight[terms] * (1_000_000_000 * times // (1000 * times + 20 * np.repeat(size, counts)))
        some = impact > 0
        row, terms, impact = row[some], terms[some], impact[some]
        order = np.lexsort((row, -impact, terms))
        self.documents, self.impacts = row[order].astype(np.int32), impact[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weight) + 1))
        # direct access: (term, document) to its place
        keys = terms[order].astype(np.int64) << 32 | row[order]
        self.places = np.argsort(keys, kind="stable")
        self.keys = keys[self.places]
        self.seen = np.zeros(len(ids), bool)

    def search(self, terms: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best (document, score) of this shard, as far as they reach the k best of the scores known before; and how many were looked up."""
        starts, ends = self.starts[terms], self.starts[terms + 1]
        some = ends > starts
        terms, starts, ends = terms[some], starts[some], ends[some]
        best = starts.copy()  # the first place of each list that is not seen yet
        offsets = np.append(0, np.cumsum(ends - starts))
        marked = np.zeros(offsets[-1], bool)
        found, scores, top, block, looked = [], [], known, BLOCK, 0
        while True:
            upto = np.minimum(best + block, ends)
            read = ranges(best, upto)
            if not len(read):
                break
            new = np.unique(self.documents[read])
            new = new[~self.seen[new]]
            self.seen[new] = True
            if len(new):
                looked += len(new)
                wanted = terms.astype(np.int64)[:, None] << 32 | new[None, :]
                spot = np.searchsorted(self.keys, wanted.ravel()).reshape(wanted.shape)
                hit = spot < len(self.keys)
                hit[hit] = self.keys[spot[hit]] == wanted[hit]
                place = self.places[spot[hit]]
                score = np.zeros(wanted.shape, np.int64)
                score[hit] = self.impacts[place]
                marked[place + np.repeat(offsets[:-1] - starts, hit.sum(axis=1))] = True
                found.append(new)
                scores.append(score.sum(axis=0))
                top = np.concatenate((top, scores[-1]))
                if len(top) > k:
                    top = np.partition(top, len(top) - k)[-k:]
            for j, (begin, end) in enumerate(zip(best.tolist(), ends.tolist())):
                if begin < end:
                    open_ = marked[offsets[j] + begin - starts[j] : offsets[j + 1]]
                    first = int(open_.argmin())
                    best[j] = end if open_[first] else begin + first
            left = best < ends
            threshold = int(self.impacts[best[left]].sum())
            if not left.any() or (len(top) >= k and threshold < top.min()):
                break
            block = min(2 * block, MOST_BLOCK)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        found, scores = np.concatenate(found), np.concatenate(scores)
        self.seen[found] = False
        able = scores >= (top.min() if len(top) >= k else 0)
        found, scores = found[able], scores[able]
        chosen = np.lexsort((found, -scores))[:k]
        return found[chosen], scores[chosen], looked


def ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places from each begin to its end."""
    sizes = end - begin
    return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Figures(NamedTuple):
    """Of the corpus and the items: documents, terms of all documents, each term's weight, and the terms of each item."""

    documents: int
    terms: int
    weight: np.ndarray
    items: list[np.ndarray]


class Search:
    """The k best documents of each item over the shards of a task."""

    def __init__(self, figures: Figures, k: int):
        self.figures, self.k = figures, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(figures.items)
        self.looked = 0

    def add(self, rows: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(rows)
        ids = table["doc_id"]
        no_id, ids = ids.is_null().to_numpy(), pc.fill_null(ids, NO_ID).to_numpy()
        order = np.lexsort((ids, no_id))
        table, ids, no_id = table.take(pa.array(order)), ids[order], no_id[order]
        f = self.figures
        size = 50 + 50 * table["n"].to_numpy() * f.documents // f.terms
        terms, times = table["terms"].combine_chunks(), table["times"].combine_chunks()
        flat = [pc.list_flatten(x).to_numpy(zero_copy_only=False) for x in (terms, times)]
        shard = Shard(ids, size, pc.list_value_length(terms).to_numpy(zero_copy_only=False), *flat, f.weight)
        for k, own in enumerate(f.items):
            scores, missing, held = self.best[k]
            found, new, looked = shard.search(own, self.k, scores)
            self.looked += looked
            if len(found):
                scores, missing, held = np.concatenate((scores, new)), np.concatenate((missing, no_id[found])), np.concatenate((held, ids[found]))
                order = np.lexsort((held, missing, -scores))[: self.k]
                self.best[k] = scores[order], missing[order], held[order]


def top_of_tasks(rows: DataFrame, figures: Figures, k: int, postings: int) -> DataFrame:
    """(part, item, score, no_id, doc_id): the k best documents of each item among those of each task."""
    shared = rows.sparkSession.sparkContext.broadcast(figures)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, held, size = Search(shared.value, k), [], 0
        for batch in batches:
            if held and size + len(batch.column("terms").values) > postings:
                search.add(held)
                held, size = [], 0
            held.append(batch)
            size += len(batch.column("terms").values)
        if held:
            search.add(held)
        sizes = [len(x[0]) for x in search.best]
        if sum(sizes):
            scores, missing, ids = (np.concatenate(x) for x in zip(*search.best))
            item = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            part = np.full(len(item), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(item), pa.array(scores), pa.array(missing), pa.array(ids, mask=missing)], ["part", "item", "score", "no_id", "doc_id"])

    return rows.mapInArrow(tx.tidy(give), RESULT)


def merged(rows: DataFrame, k: int) -> DataFrame:
    """(item, rank, score, doc_id): the k best of each item, by groups of tasks first, so that no task orders all tasks' rows of an item."""
    order = [F.desc("score"), "no_id", "doc_id"]
    group = (F.col("part") / MERGED_TASKS).cast("int")
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", group).orderBy(*order))).filter(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def group_search(docs: DataFrame, pairs: DataFrame, k: int, postings: int) -> DataFrame:
    """item_id, rank, doc_id, score for items (item_id, term) whose rows fit the driver and a broadcast."""
    held = pairs.toArrow()
    terms, items = (pc.dictionary_encode(held[c].combine_chunks(), null_encoding="encode") for c in ("term", "item_id"))
    words = [t.encode() for t in terms.dictionary.to_pylist()]
    own, of = items.indices.to_numpy(), terms.indices.to_numpy()
    order = np.argsort(own, kind="stable")
    per_item = np.split(of[order], np.cumsum(np.bincount(own, minlength=len(items.dictionary)))[:-1])
    rows = stored(matched(docs, words), "matched", compression="zstd")
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    figures = Figures(n_docs, n_terms, weights(n_docs, document_counts(rows, len(words))), per_item)
    best = stored(merged(top_of_tasks(rows, figures, k, postings), k), "best")
    drop(rows)
    ids = docs.sparkSession.createDataFrame(pa.table({"item": pa.array(np.arange(len(per_item), dtype=np.int32)), "item_id": items.dictionary}), f"item int, item_id {pairs.schema['item_id'].dataType.simpleString()}")
    return best.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, postings: int = POSTINGS, item_rows: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of each item with the highest scores above 0, equal scores by doc_id."""
    pairs = stored(item_terms(items), "item-terms")
    groups = ceil(pairs.count() / item_rows)
    group = F.pmod(F.xxhash64("item_id"), F.lit(max(1, groups)))
    out = docs.sparkSession.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    for n in range(groups):
        some = pairs.filter(group == n)
        if not some.isEmpty():
            out = out.unionByName(group_search(docs, some, k, postings))
    return out


SQL = r"""
WITH words AS (
  SELECT place, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS place, doc_id, text FROM documents)
),
sizes AS (SELECT place, count(*) AS n FROM words GROUP BY place),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark
),
found AS (SELECT place, doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM found GROUP BY term), corpus),
impacts AS (
  SELECT place, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS impact
  FROM found JOIN weights USING (term) JOIN sizes USING (place), corpus
),
scores AS (SELECT item_id, place, doc_id, sum(impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50
"""
