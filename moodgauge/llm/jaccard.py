"""Jaccard self-join on word shingles by the size-aware heavy-light method, down to components.

Equal sets are one node. Nodes are small or large by the number of their shingles; the boundary is the one with the least cost.

* Small with small: two sets of sizes s and s' link if they share a subset of t(s, s') shingles, the overlap the threshold asks for.
  Each small set gives its subsets of those fixed sizes, named with the pair of sizes, so meeting under a name is a link.
* Large with anything: shingles are ordered, frequent ones last, and a set of size s lies in the inverted lists of its first
  s - ceil(0.85 s) + 1 shingles; two sets that link meet in a list. In each round the members of a list that lie in another
  component than the list's pivots are paired with them, if sizes, places and parity bitmaps allow a link; the pairs are checked on
  the whole sets, components are formed, and lists inside one component are done. Pivots come from the largest component in the
  list, one in the first round and more in later ones. In the end all pairs that are left in different components are checked. So no link between components is lost, and the members of a group of
  near copies are never all paired with one another.

The order of shingles changes the cost, not the result. It knows at most FREQUENT shingles, those found most often within chunks.
Lists name a node by half of its digest; both halves decide what is one node.

Defined cases: a null text, or one without words, has no shingle and is its own component; fewer words than `n` count as one
shingle; rows that repeat, and rows with a null doc_id, belong to their set's component, whose name is its smallest id; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.graph import components
from moodgauge.llm.tables import drop, locator, rows_without, scanned, stored

FREQUENT = 1 << 20
SMALLEST_LARGE = 48  # no set of so many shingles is worth enumerating
FILTER_BITS, LIST_FILTER_BITS = 24, 26
BROADCAST_IDS = 1 << 20  # more are told by a bitmap of fixed size
WIDE = 64  # numbers of 64 bits in a node's long parity bitmap
PIVOTS = (1, 8, 64)  # of a list in each round
SETS = "doc_id long, row string, node binary, d1 long, size int, b1 long, b2 long, wide array<long>, shingle long, seen long"


def overlap(a, b, percent: int):
    """The least intersection of sets of sizes a and b that link: 100 * i >= percent * (a + b - i)."""
    return (percent * (a + b) + 99 + percent) // (100 + percent)


def least_partner(size, percent: int):
    return (percent * size + 99) // 100


def ordered(text: np.ndarray, shingles: np.ndarray, level: np.ndarray | None = None) -> np.ndarray:
    """The order by text, level and shingle; by one number where its bits tell all rows apart that differ."""
    if len(text) and int(text[-1]) < 1 << 16:
        short = np.uint64(16 if level is None else 22)
        key = text.astype(np.uint64) << np.uint64(48) | shingles >> short
        if level is not None:
            key |= level.astype(np.uint64) << np.uint64(42)
        order = np.argsort(key)
        key, found = key[order], shingles[order]
        if not ((key[1:] == key[:-1]) & (found[1:] != found[:-1])).any():
            return order
    return np.lexsort((shingles, text) if level is None else (shingles, level, text))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, end to end, and where each text's begin (one more at the end)."""
    lowered = tx.LOWER[data]
    begin, end, at = tx.words(lowered, offsets)
    hashes, counts = tx.span_hash(tx.sums(lowered), begin, end), np.diff(at)
    places, text = tx.whole_windows(counts, n)
    found, of = [tx.grams(hashes, n)[places]], [text]
    for few in range(1, n):
        short = np.flatnonzero(counts == few)
        if len(short):
            found.append(tx.grams(hashes, few)[at[:-1][short]])
            of.append(short)
    shingles, text = np.concatenate(found), np.concatenate(of)
    if len(found) > 1:
        order = np.argsort(text, kind="stable")
        shingles, text = shingles[order], text[order]
    order = ordered(text, shingles)
    shingles, text = shingles[order], text[order]
    if len(text):
        first = np.append(True, (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1]))
        shingles, text = shingles[first], text[first]
    return shingles, np.searchsorted(text, np.arange(len(offsets)))


def folded(values: np.ndarray, at: np.ndarray, how: np.ufunc) -> np.ndarray:
    """One value per run; runs without values give 0."""
    out = np.zeros(len(at) - 1, values.dtype)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        out[some] = how.reduceat(values, at[:-1][some])
    return out


def digests(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16 bytes per set, equal for equal sets; two sums of mixed shingles."""
    parts = [folded(tx.mix(shingles ^ np.uint64(salt)), at, np.add) for salt in (0x51ED270B, 0xA0761D64)]
    return np.stack(parts, 1)


def parity(shingles: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A bitmap of WIDE numbers per set: whether an odd number of its shingles falls on each bit. Two bitmaps differ in at most as many bits as the sets in shingles."""
    room = WIDE * 64
    text = np.repeat(np.arange(len(size)), size)
    odd = np.bincount(text * room + (shingles % np.uint64(room)).astype(np.int64), minlength=len(size) * room) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(size), room), axis=1).view(np.uint64)


def binaries(rows: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Rows of 64-bit numbers as binary values."""
    width = rows.shape[1] * 8
    raw = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    out = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return out if valid is None else pa.compute.if_else(pa.array(valid), out, pa.scalar(None, pa.binary()))


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def read_sets(docs: DataFrame, n: int) -> DataFrame:
    """A row per document (doc_id, row, node, size, b1, b2), and rows (shingle, seen) of shingles seen in 3 or more texts of a chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", most_rows=512):
                shingles, at = shingle_sets(data, offsets, n)
                size = np.diff(at)
                wide = parity(shingles, size)
                halves = [np.bitwise_xor.reduce(wide[:, k::2], 1) for k in (0, 1)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * WIDE), signed(wide.ravel()))
                found, seen = np.unique(shingles, return_counts=True)
                often = seen >= 3
                found, seen = found[often], seen[often]
                count, more = len(size), len(found)
                node = digests(shingles, at)
                columns = [rows.column("doc_id").cast(pa.int64()), rows.column("row").cast(pa.string()), binaries(node, size > 0), signed(node[:, 0]), pa.array(size.astype(np.int32)), *map(signed, halves), lists]
                of_docs = pa.RecordBatch.from_arrays([*columns, pa.nulls(count, pa.int64()), pa.nulls(count, pa.int64())], ["doc_id", "row", "node", "d1", "size", "b1", "b2", "wide", "shingle", "seen"])
                yield of_docs
                nothing = [pa.nulls(more, field.type) for field in of_docs.schema][:8]
                yield pa.RecordBatch.from_arrays([*nothing, signed(found), pa.array(seen.astype(np.int64))], of_docs.schema.names)

    return docs.select(F.col("doc_id").cast("long"), "text", "row").mapInArrow(tx.tidy(read), SETS)


def subsets_given(size: int, boundary: int, percent: int) -> list[tuple[int, int]]:
    """(partner's size, overlap) for each size of a small partner of a small set."""
    sizes = range(least_partner(size, percent), min(100 * size // percent, boundary - 1) + 1)
    return [(other, t) for other in sizes if (t := overlap(size, other, percent)) <= min(size, other)]


def cheapest_boundary(sizes: dict[int, int], partners: float, percent: int) -> int:
    """The size from which lists cost less than subsets. partners: mean number of other sets in a list."""
    best = (float("inf"), 1)
    for boundary in range(1, SMALLEST_LARGE + 1):
        small = sum(n * comb(s, t) for s, n in sizes.items() if s < boundary for _, t in subsets_given(s, boundary, percent))
        large = sum(n * (s - least_partner(s, percent) + 1) for s, n in sizes.items() if s >= least_partner(boundary, percent))
        best = min(best, (small + large * (1 + partners), boundary))
    return best[1]


def subset_names(sets: np.ndarray, size: int, other: int, t: int) -> np.ndarray:
    """Names of all subsets of t shingles of each row, as rows x subsets x 2 numbers."""
    left_out = np.array(list(combinations(range(size), size - t)), np.int64).reshape(comb(size, t), size - t)
    pair = np.uint64(min(size, other) * 1_000_003 + max(size, other))
    out = []
    for salt in (0x3C6EF372, 0xBB67AE85):
        mixed = tx.mix(sets ^ np.uint64(salt))
        out.append(tx.mix((mixed.sum(1, dtype=np.uint64)[:, None] - mixed[:, left_out].sum(2, dtype=np.uint64)) ^ tx.mix(np.array([pair]))[0]))
    return np.stack(out, 2)


def signatures(docs: DataFrame, n: int, percent: int, boundary: int, frequent: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(shingle, d1, spot) of inverted lists, where spot is size << 32 | place, and (name, other, node, size) of subsets."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, rank))
    lowest = least_partner(boundary, percent)
    names = ["shingle", "d1", "spot", "name", "other", "node", "size"]
    kinds = [pa.int64()] * 3 + [pa.binary(), pa.int32(), pa.binary(), pa.int32()]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        for batch in batches:
            for _, data, offsets in tx.chunks(batch, "text"):
                shingles, at = shingle_sets(data, offsets, n)
                node = digests(shingles, at)
                size = np.diff(at)
                # equal sets of a chunk give their rows once
                _, first = np.unique(node, axis=0, return_index=True)
                chosen = np.zeros(len(size), bool)
                chosen[first] = True
                text = np.repeat(np.arange(len(size)), size)
                used = np.repeat(chosen & (size >= lowest), size)
                text, listed = text[used], shingles[used]
                spot = np.minimum(np.searchsorted(frequent, listed), max(len(frequent) - 1, 0))
                level = np.where(frequent[spot] == listed, rank[spot], 0) if len(frequent) else np.zeros(len(listed), np.int64)
                order = ordered(text, listed, level)
                text, listed = text[order], listed[order]
                place = np.arange(len(text)) - np.searchsorted(text, np.arange(len(size)))[text]
                inside = place <= size[text] - least_partner(size[text], percent)
                text, listed, place = text[inside], listed[inside], place[inside]
                if k := len(text):
                    rows = [signed(listed), signed(node[text, 0]), pa.array(size[text] << 32 | place)]
                    yield pa.RecordBatch.from_arrays(rows + [pa.nulls(k, kind) for kind in kinds[3:]], names)
                for s in range(1, boundary):
                    own = np.flatnonzero(chosen & (size == s))
                    for other, t in subsets_given(s, boundary, percent) if len(own) else ():
                        step = max(1, 200_000 // comb(s, t))
                        for part in (own[k : k + step] for k in range(0, len(own), step)):
                            name = subset_names(shingles[at[part][:, None] + np.arange(s)], s, other, t)
                            whole = np.repeat(node[part], name.shape[1], 0)
                            k = len(whole)
                            rows = [binaries(name.reshape(k, 2)), pa.array(np.full(k, other, np.int32)), binaries(whole), pa.array(np.full(k, s, np.int32))]
                            yield pa.RecordBatch.from_arrays([pa.nulls(k, kind) for kind in kinds[:3]] + rows, names)

    return docs.select("text").mapInArrow(tx.tidy(give), "shingle long, d1 long, spot long, name binary, other int, node binary, size int")


def subset_links(given: DataFrame) -> DataFrame:
    """Links among small sets: each member of a name with the name's smallest node, if the name's two sizes are both there."""
    groups = given.groupBy("name").agg(F.min("node").alias("a"), F.max("node").alias("most"), F.min("size").alias("s1"), F.max("size").alias("s2"), F.max((F.col("other") != F.col("size"))).alias("two"))
    met = groups.filter("a <> most and (not two or s1 <> s2)").select("name", "a")
    return given.select("name", F.col("node").alias("b")).join(met, "name").filter("a <> b").select("a", "b").distinct()


def may_link(x: str, y: str, percent: int) -> Column:
    """Whether the sizes, places and bitmaps of two members of a list leave room for a link."""
    size_x, size_y = F.col(f"{x}.size"), F.col(f"{y}.size")
    need = F.floor((percent * (size_x + size_y) + 99 + percent) / (100 + percent))
    differ = F.bit_count(F.col(f"{x}.b1").bitwiseXOR(F.col(f"{y}.b1"))) + F.bit_count(F.col(f"{x}.b2").bitwiseXOR(F.col(f"{y}.b2")))
    return (size_x - F.col(f"{x}.place") >= need) & (size_y - F.col(f"{y}.place") >= need) & (need <= F.least(size_x, size_y)) & (differ <= size_x + size_y - 2 * need)


def bit_place(column: str, bits: int):
    return F.pmod(F.xxhash64(column), F.lit(1 << bits))


def bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of fixed size (2**bits bits) that holds the hashes of all values; others may be held too."""
    place = bit_place(column, bits) + 1  # these functions count from 1
    blocks = values.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for block, found in blocks.toLocalIterator():  # at most 2**bits / 32768 rows of 4 KB
        out[(block - 1) * 4096 : block * 4096] = np.frombuffer(found, np.uint8)
    return out


def in_bitmap(held: np.ndarray, places: pa.Array) -> np.ndarray:
    at = places.to_numpy(zero_copy_only=False)
    return (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def sets_of_nodes(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, shingles) of wanted nodes, and perhaps of some more. wanted: doc_ids, one or more of each wanted node."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in tx.chunks(batch, "text"):
                shingles, starts = shingle_sets(data, offsets, n)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), signed(shingles))
                yield pa.RecordBatch.from_arrays([binaries(digests(shingles, starts), np.diff(starts) > 0), lists], ["node", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(wanted.select(F.col("doc_id").alias("wanted_id")).distinct())
        rows = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
        return rows.mapInArrow(tx.tidy(give), "node binary, shingles array<long>")
    held = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.filter("doc_id is not null"), "doc_id", FILTER_BITS))

    def give_likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = in_bitmap(held.value, batch.column("place")) | batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            yield from give([batch.filter(pa.array(known))])

    return rows.withColumn("place", bit_place("doc_id", FILTER_BITS)).mapInArrow(tx.tidy(give_likely), "node binary, shingles array<long>")


def checked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b), given by halves of digests, whose whole sets link, by nodes. Long bitmaps go first, whole sets decide."""
    side = F.struct("node", "size", "wide")
    x = nodes.select(F.col("d1").alias("a"), side.alias("x"))
    y = nodes.select(F.col("d1").alias("b"), side.alias("y"))
    size = F.col("x.size") + F.col("y.size")
    differ = F.aggregate(F.zip_with("x.wide", "y.wide", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda a, b: a + b)
    likely = pairs.join(x, "a").join(y, "b").filter(differ <= size - 2 * F.floor((percent * size + 99 + percent) / (100 + percent)))
    likely = stored(likely.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "likely-pairs")
    both = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    wanted = stored(nodes.join(both, "node", "left_semi").select("doc_id"), "wanted")
    sets = stored(sets_of_nodes(docs, wanted, n), "wanted-sets")
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    # texts that repeat a node's id may give its set again
    linked = likely.join(a, "a").join(b, "b").filter((100 + percent) * common >= percent * (F.size("of_a") + F.size("of_b")))
    out = stored(linked.select("a", "b").distinct(), "linked")
    drop(likely, wanted, sets)
    return out


def shared_lists(given: DataFrame) -> DataFrame:
    """(shingle, d1, spot) of lists with several nodes. Entries of other lists are told by a bitmap of fixed size before the shuffle."""
    counted = given.groupBy("shingle").agg(F.min("d1").alias("n1"), F.max("d1").alias("n2"))
    several = stored(counted.filter("n1 <> n2").select("shingle"), "shared")
    held = given.sparkSession.sparkContext.broadcast(bitmap(several, "shingle", LIST_FILTER_BITS))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(held.value, batch.column("bit")))).drop_columns(["bit"])

    likely = given.withColumn("bit", bit_place("shingle", LIST_FILTER_BITS)).mapInArrow(tx.tidy(keep), given.schema)
    return stored(likely.distinct().join(several, "shingle"), "lists")


def with_roots(lists: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(shingle, d1, spot, x) of the lists with several components; x has d1, size, place, b1, b2, root (hashed) and its members."""
    sized = roots.join(roots.groupBy("root").agg(F.count("*").alias("members")), "root")
    known = nodes.select("d1", "node", "b1", "b2").join(sized, "node", "left")
    known = known.select("d1", "b1", "b2", F.xxhash64(F.coalesce("root", "node")).alias("root"), F.coalesce("members", F.lit(1)).alias("members"))
    members = stored(lists.join(known, "d1"), "members")
    several = members.groupBy("shingle").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("shingle")
    out = stored(members.join(several, "shingle", "left_semi"), "open-lists")
    drop(members)
    return out


def member() -> Column:
    """A row of a list as one value."""
    size, place = F.shiftright("spot", 32).cast("int").alias("size"), F.col("spot").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("place")
    return F.struct("d1", size, place, "b1", "b2", "root", "members")


def ordered_pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.d1", "y.d1").alias("a"), F.greatest("x.d1", "y.d1").alias("b")).distinct()


def pivot_pairs(members: DataFrame, pivots: int, percent: int) -> DataFrame:
    """Members of a list with its pivots: of each of so many parts of the nodes, the one in the largest component with the least hash.

    Lists of one group tend to have the same pivots, so their pairs are the same.
    """
    part = F.pmod(F.xxhash64("d1", F.lit(pivots)), F.lit(pivots))
    order = F.struct(-F.col("members"), "root", F.xxhash64("d1", F.lit(-pivots)))
    chosen = members.groupBy("shingle", part.alias("part")).agg(F.min_by(member(), order).alias("y")).select("shingle", "y")
    met = members.select("shingle", member().alias("x")).join(chosen, "shingle")
    return ordered_pairs(met.filter((F.col("x.root") != F.col("y.root")) & may_link("x", "y", percent)))


def remaining_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of members of a list that lie in different components and may link."""
    # bands are a little wider than the threshold, so partners lie in the same band of sizes or the next
    band = F.floor(F.log(F.col("x.size").cast("double")) / F.log(F.lit(100 / (percent - 1)))).cast("int")
    rows = members.select("shingle", member().alias("x"))
    left = rows.select("shingle", band.alias("band"), "x")
    right = rows.select("shingle", F.explode(F.array(band - 1, band, band + 1)).alias("band"), F.col("x").alias("y"))
    met = left.join(right, ["shingle", "band"]).filter("x.d1 < y.d1 and x.root <> y.root")
    return ordered_pairs(met.filter(may_link("x", "y", percent)))


def list_roots(lists: DataFrame, links: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Components from links and from all links that the lists show."""
    roots = components(links)
    members = with_roots(lists, nodes, roots)
    for pivots in PIVOTS:
        found = checked(stored(pivot_pairs(members, pivots, percent), "pivot-pairs"), docs, nodes, n, percent)
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = components(links)
            before, members = members, with_roots(members.select("shingle", "d1", "spot"), nodes, roots)
            drop(before)
    pairs = stored(remaining_pairs(members, percent), "remaining-pairs")
    drop(members)
    if pairs.isEmpty():
        return roots
    return components(links.unionByName(checked(pairs, docs, nodes, n, percent)))


def document_order():
    """Orders documents by doc_id, nulls last, then by the name of the row."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def set_components(docs: DataFrame, n: int = 4, percent: int = 85, boundary: int | None = None) -> DataFrame:
    """doc_id, row, size, node and the component's first document (no_id, doc_id, row) for every row of doc_id, text, row."""
    read = stored(read_sets(docs, n), "sets")
    sets = read.filter("size is not null").select("doc_id", "row", "node", "d1", "size", "b1", "b2", "wide")
    nodes = sets.filter("node is not null").groupBy("node", "d1", "size", "b1", "b2").agg(F.min(document_order()).alias("first"), F.first("wide").alias("wide"))
    nodes = stored(nodes.withColumn("doc_id", F.col("first.doc_id")), "nodes")
    words = sets.agg(F.sum("size")).first()[0] or 0
    hints = read.filter("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    least = max(16, -(-words // FREQUENT))
    often = hints.filter(F.col("seen") >= least).toArrow()  # at most FREQUENT rows
    frequent = often["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(frequent)
    rank = 1 + np.log2(often["seen"].to_numpy()).astype(np.int64)
    repeats = read.agg(F.sum(F.col("seen") - 1)).first()[0] or 0
    sizes = dict(nodes.filter(F.col("size") <= 2 * SMALLEST_LARGE).groupBy("size").count().collect())
    if boundary is None:
        boundary = cheapest_boundary(sizes, repeats / max(words, 1), percent)
    given = stored(signatures(docs, n, percent, boundary, frequent[order], rank[order]), "signatures")
    links = stored(subset_links(given.filter("name is not null").select("name", "other", "node", "size")), "subset-links")
    lists = shared_lists(given.filter("shingle is not null").select("shingle", "d1", "spot"))
    drop(given)
    roots = list_roots(lists, links, docs, nodes, n, percent)
    named = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    of_node = named.join(named.groupBy("root").agg(F.min("first").alias("component")), "root").select("node", "component")
    alone = F.when(F.col("node").isNull(), document_order()).otherwise(F.col("component"))
    return sets.join(of_node, "node", "left").select("doc_id", "row", "size", "node", alone.alias("component"))


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    out = set_components(docs.select("doc_id", "text", F.lit(None).cast("string").alias("row")), **options)
    return out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.col("component.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The first document of each component, with all columns. A frame that is no scan of files is written first."""
    docs = scanned(docs)
    gone = set_components(docs.select("doc_id", "text", locator(docs).alias("row")), **options).filter("row <> component.row")
    return rows_without(docs, gone.select(F.col("row").alias("locator")))
