"""Near copies by SimHash fingerprints, linked through vantage-point trees of their Hamming distances.

A fingerprint has 64 bits; bit k is set if it is set in over half the XXH64 values of the text's shingles. Equal fingerprints are one
node. Two of them link at `distance` or fewer differing bits, so in at least one of `bands` bands of bits they differ in at most
distance // bands: that is the reach of a search in this band, and each band has a vantage-point tree.

A tree cuts at a distance from a vantage point: nearer values go left, the others right. A value that is searched with reach r goes
left if its distance is at most the cut plus r, right if it is more than the cut less r; by the triangle inequality nothing within reach
lies on a side that is not visited. The upper levels are fitted on a bounded sample and make the shards: each fingerprint lies in one
shard per band and is sent as a query to those later shards that its reach overlaps, so a pair meets once per band. A shard that has too many
rows is cut into pieces, its queries into groups, and each piece meets each group. In a task a tree of the same kind over a cell's
fingerprints leads its queries to small leaves, where all 64 bits decide. A leaf gives no more links than keep its classes together.

Defined cases: a text without words (null, empty, white space) has fingerprint zero, which links like any other; fewer words than a
shingle are one shingle; rows that repeat are rows of one class; a null doc_id is never the smallest, and a class that has no other gets
a null component_id; further columns are ignored; an empty table gives an empty result. A task holds one chunk of about 2 MB of text, or
one longer text, at some 30 bytes a byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.graph import components
from moodgauge.llm.tables import drop, joined_by_key, small, stored

SHINGLE = 4
DISTANCE = 4
BANDS = 3
SEED = 42
# fingerprints that a cell holds, and queries that it answers
SHARD_ROWS = 1 << 13
SHARD_QUERIES = 1 << 18
LEAF = 256
# the sample that the upper levels are fitted on: at most so many, of one sixteenth of the fingerprints
SAMPLE = 1 << 18
SAMPLE_SHARE = 16
PER_SHARD = 16
HASH_BLOCK = 1 << 16
LANES = np.uint64(0x0101010101010101)


# fingerprints


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case with one space after each word, begin and end of the words there, and how many words lie before each text."""
    lowered = tx.LOWER[data]
    begin, end, at = tx.words(lowered, offsets)
    space = tx.SPACE[lowered]
    kept = ~space
    after = end[end < len(data)]
    kept[after] = True
    lowered[after[space[after]]] = 32
    place = np.cumsum(kept) - 1
    begin_now = place[begin] if len(begin) else begin
    return lowered[kept].tobytes(), begin_now, begin_now + end - begin, at


def shingle_spans(begin: np.ndarray, end: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each shingle, and how many each text has; a text of fewer words has one, of all of them."""
    number = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    first = np.repeat(np.cumsum(counts) - counts, number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    last = first + np.repeat(np.minimum(counts, n), number) - 1
    return begin[first], end[last], number


def span_hashes(raw: bytes, begin: np.ndarray, end: np.ndarray) -> Iterator[np.ndarray]:
    """XXH64 of the spans, in blocks."""
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(begin), HASH_BLOCK):
        some = zip(begin[k : k + HASH_BLOCK].tolist(), end[k : k + HASH_BLOCK].tolist())
        yield np.array([digest(raw[a:b], SEED) for a, b in some], np.uint64)


def bit_counts(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups, ascending, and in how many hashes of each every bit is set. group: ascending.

    Eight bits are summed at once in the bytes of a word, in runs of at most 255 hashes.
    """
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    lengths = np.diff(np.append(starts, len(group)))
    runs = -(-lengths // 255)
    within = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = np.repeat(starts, runs) + 255 * within
    sums = np.empty((len(begin), 8, 8), np.uint8)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & LANES, begin)
        sums[:, :, shift] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
    return group[starts], np.add.reduceat(sums.reshape(-1, 64), np.cumsum(runs) - runs, axis=0, dtype=np.int64)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    raw, begin, end, at = spaced(data, offsets)
    begin, end, number = shingle_spans(begin, end, np.diff(at), n)
    text = np.repeat(np.arange(len(number)), number)
    counts = np.zeros((len(number), 64), np.int64)
    done = 0
    for hashes in span_hashes(raw, begin, end):
        groups, sums = bit_counts(hashes, text[done : done + len(hashes)])
        counts[groups] += sums
        done += len(hashes)
    bits = 2 * counts > number[:, None]
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u8").astype(np.uint64)


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits in a signed long."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fingerprints_of(data, offsets, n).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tx.tidy(give), "doc_id long, fp long")


# vantage-point trees


class Tree(NamedTuple):
    """All nodes of a full tree, from 1; the children of k are 2 k and 2 k + 1. The distance is that of the bits in `mask`."""

    mask: np.uint64
    depth: int
    vantage: np.ndarray
    cut: np.ndarray


def masks(bands: int) -> list[np.uint64]:
    borders = [64 * k // bands for k in range(bands + 1)]
    return [np.uint64((1 << b) - (1 << a)) for a, b in zip(borders, borders[1:])]


def best_cut(values: np.ndarray, mask: np.uint64, reach: int) -> tuple[np.uint64, int]:
    """Of some vantage points the one, and its cut, after which a value meets the fewest others."""
    best = (1.0, np.uint64(0), 64)
    for vantage in values[np.linspace(0, len(values) - 1, min(4, len(values))).astype(int)] if len(values) else []:
        share = np.cumsum(np.bincount(np.bitwise_count((values ^ vantage) & mask), minlength=65)) / len(values)
        upto = share[np.minimum(np.arange(65) + reach, 64)]
        beyond = 1 - np.concatenate((np.zeros(reach), share))[:65]
        cost = share * upto + (1 - share) * beyond
        cut = int(np.argmin(cost))
        if cost[cut] < best[0]:
            best = (cost[cut], vantage, cut)
    return best[1:]


def fit(values: np.ndarray, mask: np.uint64, depth: int, reach: int) -> Tree:
    tree = Tree(mask, depth, np.zeros(1 << depth, np.uint64), np.full(1 << depth, 64, np.int64))
    node = np.ones(len(values), np.int64)
    for level in range(depth):
        order = np.argsort(node, kind="stable")
        values, node = values[order], node[order]
        for k, begin, end in zip(own := range(1 << level, 2 << level), np.searchsorted(node, own), np.searchsorted(node, own, "right")):
            tree.vantage[k], tree.cut[k] = best_cut(values[begin:end], mask, reach)
        node = 2 * node + (np.bitwise_count((values ^ tree.vantage[node]) & mask) > tree.cut[node])
    return tree


def visits(tree: Tree, values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """All (place of a value, leaf) where something within reach of it may lie; with reach 0 the leaf where it lies."""
    row, node = np.arange(len(values)), np.ones(len(values), np.int64)
    for _ in range(tree.depth):
        away, cut = np.bitwise_count((values[row] ^ tree.vantage[node]) & tree.mask), tree.cut[node]
        left, right = away <= cut + reach, away > cut - reach
        row, node = np.concatenate((row[left], row[right])), np.concatenate((2 * node[left], 2 * node[right] + 1))
    return row, node - (1 << tree.depth)


def spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a table of links the rows that are not the first of their class, the columns with a link, and the first row of each row and column."""
    rows, label = near.shape[0], np.arange(near.shape[0])
    while True:
        of_column = np.where(near, label[:, None], rows).min(axis=0)
        moved = np.minimum(label, np.where(near, of_column[None, :], rows).min(axis=1))
        if (moved == label).all():
            break
        label = moved
    column = np.flatnonzero(of_column < rows)
    return np.flatnonzero(label < np.arange(rows)), column, label, of_column


def linked(held: np.ndarray, asked: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two small sets of fingerprints, at most in proportion to their sizes, none of one with itself."""
    for k in range(0, len(asked), step := max(1, (1 << 20) // max(1, len(held)))):
        some = asked[k : k + step]
        near = np.bitwise_count(held[:, None] ^ some[None, :]) <= distance
        row, column = np.nonzero(near)
        if len(row) > 4 * (len(held) + len(some)):
            rows, columns, label, of_column = spanning(near)
            a = np.concatenate((held[rows], some[columns]))
            b = np.concatenate((held[label[rows]], held[of_column[columns]]))
        else:
            a, b = held[row], some[column]
        own = a != b
        if own.any():
            yield a[own], b[own]


def search(held: np.ndarray, asked: np.ndarray, mask: np.uint64, distance: int, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a cell's fingerprints with its queries, through a tree over the former."""
    depth = max(0, round(log2(max(1, len(held)) / LEAF)))
    tree = fit(held, mask, depth, reach)
    row, leaf = visits(tree, held, 0)
    order = np.argsort(leaf, kind="stable")
    held, leaf = held[row[order]], leaf[order]
    for k in range(0, len(asked), 1 << 16):
        some = asked[k : k + (1 << 16)]
        row, to = visits(tree, some, reach)
        order = np.argsort(to, kind="stable")
        row, to = row[order], to[order]
        own = np.unique(to)
        for here, a, b, c, d in zip(own, np.searchsorted(leaf, own), np.searchsorted(leaf, own, "right"), np.searchsorted(to, own), np.searchsorted(to, own, "right")):
            yield from linked(held[a:b], some[row[c:d]], distance)


# links and classes


def shard_trees(fps: DataFrame, rows: int, bands: int, reach: int, shard_rows: int) -> list[Tree]:
    """A tree per band, fitted on a bounded sample; with about `shard_rows` fingerprints in a leaf as far as the sample tells."""
    depth = max(0, ceil(log2(max(1, rows) / shard_rows)))
    size = min(SAMPLE, PER_SHARD << depth)
    depth = min(depth, int(log2(SAMPLE // PER_SHARD)))
    held = np.zeros(0, np.uint64)
    if depth:
        order = F.xxhash64("fp")
        sample = fps.filter(F.pmod(order, F.lit(SAMPLE_SHARE)) == 0).select("fp", order.alias("order")).orderBy("order", "fp").limit(size)
        held = sample.select("fp").toArrow()["fp"].to_numpy().view(np.uint64)
    return [fit(held, mask, depth, reach) for mask in masks(bands)]


def shard_rows_of(fps: DataFrame, trees: list[Tree], reach: int) -> DataFrame:
    """(shard, asks, fp): where each fingerprint lies, and the shards it asks: its own, and later ones within reach."""
    shared = fps.sparkSession.sparkContext.broadcast(trees)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for band, tree in enumerate(shared.value):
                lies = np.empty(len(values), np.int64)
                row, leaf = visits(tree, values, 0)
                lies[row] = leaf
                row, leaf = visits(tree, values, reach)
                later = leaf >= lies[row]
                row, leaf = np.concatenate((np.arange(len(values)), row[later])), np.concatenate((lies, leaf[later]))
                asks = np.arange(len(row)) >= len(values)
                yield pa.RecordBatch.from_arrays([pa.array(leaf << 8 | band), pa.array(asks), pa.array(values[row].view(np.int64))], ["shard", "asks", "fp"])

    return fps.select("fp").mapInArrow(give, "shard long, asks boolean, fp long")


def cells(rows: DataFrame, shard_rows: int, shard_queries: int) -> DataFrame:
    """(shard, piece, asked_by, asks, fp): shards with many rows in pieces, their queries in groups; each piece meets each group."""
    size = rows.groupBy("shard").agg(F.count_if(~F.col("asks")).alias("held"), F.count_if("asks").alias("asked"))
    several = [F.ceil(F.col("held") / (2 * shard_rows)).cast("int").alias("pieces"), F.ceil(F.col("asked") / shard_queries).cast("int").alias("groups")]
    size = stored(size.select("shard", *several).filter("pieces > 1 OR groups > 1"), "large-shards")
    dealt = rows.join(small(size), "shard", "left").withColumns({"pieces": F.coalesce("pieces", F.lit(1)), "groups": F.coalesce("groups", F.lit(1))})
    deal = F.xxhash64("fp")
    of = {
        "piece": F.when(F.col("asks"), F.sequence(F.lit(0), F.col("pieces") - 1)).otherwise(F.array(F.pmod(deal, "pieces").cast("int"))),
        "asked_by": F.when(F.col("asks"), F.array(F.pmod(deal, "groups").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("groups") - 1)),
    }
    return dealt.withColumns(of).withColumn("piece", F.explode("piece")).withColumn("asked_by", F.explode("asked_by")).select("shard", "piece", "asked_by", "asks", "fp")


def links(fps: DataFrame, distance: int = DISTANCE, bands: int = BANDS, shard_rows: int = SHARD_ROWS, shard_queries: int = SHARD_QUERIES) -> DataFrame:
    """(a, b): links between distinct fingerprints (fp) that join all that differ in `distance` or fewer bits, in the same classes."""
    reach, mask_of = distance // bands, masks(bands)
    trees = shard_trees(fps, fps.count(), bands, reach, shard_rows)
    cell = ["shard", "piece", "asked_by"]
    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), bands << trees[0].depth)
    dealt = cells(shard_rows_of(fps, trees, reach), shard_rows, shard_queries).repartition(tasks, *cell).sortWithinPartitions(*cell, "asks")

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, asked = None, [], []

        def answers() -> Iterator[pa.RecordBatch]:
            if held and asked:
                for a, b in search(np.concatenate(held), np.concatenate(asked), mask_of[now[0] & 255], distance, reach):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in cell])
            values, asks = batch.column("fp").to_numpy().view(np.uint64), batch.column("asks").to_numpy(zero_copy_only=False)
            borders = np.append(np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1, batch.num_rows)
            begin = 0
            for end in borders.tolist():
                here = tuple(keys[:, begin].tolist())
                if here != now:
                    yield from answers()
                    now, held, asked = here, [], []
                some, is_query = values[begin:end], asks[begin:end]
                held, asked = held + [some[~is_query]], asked + [some[is_query]]
                begin = end
        yield from answers()

    return dealt.mapInArrow(tx.tidy(give), "a long, b long")


def classes(fps: DataFrame, distance: int = DISTANCE, **options) -> DataFrame:
    """(fp, component_id) for stored rows (fp, first, n) of distinct fingerprints; component_id: the smallest `first` of the class."""
    roots = stored(components(links(fps.select("fp"), distance, **options)).select(F.col("node").alias("fp"), "root"), "roots")
    near = stored(fps.join(roots, "fp").select("fp", "first", "root"), "near")
    of_root = stored(near.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n")), "classes")
    rows = near.count()
    joined = joined_by_key(near.select("fp", "root"), of_root.select("root", "component_id"), "root", of_root, rows).select("fp", "component_id")
    alone = fps.join(roots.select("fp"), "fp", "left_anti").select("fp", F.col("first").alias("component_id"))
    out = stored(joined.unionByName(alone), "component-of")
    drop(roots, near, of_root)
    return out


def simhash_components(docs: DataFrame, n: int = SHINGLE, distance: int = DISTANCE, **options) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id for every row."""
    rows = stored(fingerprints(docs, n), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct-fingerprints")
    joined = joined_by_key(rows, classes(fps, distance, **options), "fp", fps, rows.count())
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
