"""Repeated byte strings: equal phrases are folded, then a distributed suffix array with a difference cover modulo 3 decides the rest.

Folding. Every string of `length` bytes (a window) has an anchor, the first least hash of length / 2 bytes in it, so equal windows have
equal anchors at the same place within. Consecutive windows with one anchor form a phrase. A phrase whose bytes also stand earlier
consists of repeated windows only; of equal phrases the first stays, and stands for all of them as the earlier text. A window of a
phrase that stays can be repeated only if its anchor has two different phrases. Within those phrases, runs of windows that are
counted twice or more are folded the same way. What stays goes into the suffix array, window by window.

Suffix array. A run is read in symbols of `unit` bytes (hashes), as `unit` interleaved strings of symbols; `length` is a multiple of
`unit`, so two suffixes share `length` bytes if and only if they share length / unit symbols. Any order of symbols gives a suffix array
that serves.

1. Sampled suffixes (place modulo 3 is not 0 in their string) are sorted by triples of symbols and named by their rank.
2. While names leave ties within the needed depth, the strings of names (places 1, then places 2, modulo 3) are sorted the same way.
3. The remaining suffixes are sorted by (symbol, rank of the next suffix) and merged with the sample: against places 1 by
   (symbol, next rank), against places 2 by (symbol, next symbol, rank after it).
4. Adjacent suffixes that share `length` bytes form a group; all its members but the earliest begin a repeated string.

Anchors and windows are counted over all texts; those found twice are told by bitmaps of fixed size, which may let more through but
never fewer. Text is dealt to slices, and a count says in which slices a hash stands. If there is much to tell, slices are worked on
in groups, one after the other, each with a bitmap of the hashes that stand in it; so a bitmap is filled by the repeats of a bounded
part of the text, whatever the size of the whole (up to SLICES groups; beyond, groups grow). Equal phrases meet in an aggregate that
combines before its shuffle and in a join, in a few rounds of hashes if there are many; hot phrases, of which there is a bounded
number, are broadcast to it, so a group of copies of any size stays where it was read. Sorting partitions by the first symbol, so
suffixes that compare equal are together.

Defined cases: a null or empty text has no byte; a null doc_id counts as later than all others; among rows with equal doc_ids the
order is that of the scan; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.exact import located
from moodgauge.llm.tables import drop, stored
from moodgauge.session import scratch_path

FILTER_BITS = 27
# parts of the text (bits of a long), and the places of repeated hashes that those of them which share a bitmap should have at most
SLICES = 60
GROUP_PLACES = 1 << 24
# runs that are folded at once, by their hashes, up to so many rounds
FOLD_ROWS = 1 << 24
FOLD_ROUNDS = 4
ROWS_PER_PART = 1 << 20
# what may be broadcast of the removed runs: rows, and runs in their arrays (16 bytes each)
BROADCAST_SPANS = 1 << 18
BROADCAST_RUNS = 1 << 20
# keys with more than this share of all rows are joined by a broadcast, so there are fewer of them than this
HOT_KEYS = 1 << 14
# text worked on at once; each byte takes some hundred bytes of arrays
CHUNK_BYTES = 1 << 20


def sliding(values: np.ndarray, window: int, how: np.ufunc, filler: int) -> np.ndarray:
    """The least or largest of each `window` consecutive values (running folds of blocks, forwards and backwards)."""
    n = len(values) - window + 1
    if n <= 0:
        return values[:0]
    padded = np.append(values, np.full(-len(values) % window, filler, values.dtype)).reshape(-1, window)
    ahead = how.accumulate(padded, axis=1).ravel()
    behind = how.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return how(behind[:n], ahead[window - 1 : window - 1 + n])


def place_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of the `size` bytes from each place on; places without so many bytes have none."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    begin = np.arange(len(data) - size + 1)
    return tx.span_hash(tx.sums(data), begin, begin + size)


def phrases(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window and number of windows of each phrase, the hash of its anchor, and that of its bytes."""
    half = length // 2
    running = tx.sums(data)
    begin = np.arange(max(0, len(data) - half + 1))
    hashes = tx.span_hash(running, begin, begin + half)
    least = sliding(hashes, length - half + 1, np.minimum, np.iinfo(np.uint64).max)
    if not len(least):
        return begin[:0], begin[:0], hashes[:0], hashes[:0]
    whole = np.arange(len(least)) + length <= np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    new = np.ones(len(least), bool)
    # the anchor changes when a smaller hash comes in or when it stood at the very beginning of the window before
    new[1:] = (least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(least)))
    inside = whole[first]
    first, size = first[inside], size[inside]
    return first, size, least[first], tx.span_hash(running, first, first + size + (length - 1))


def free(df: DataFrame) -> None:
    """Lets Spark's cleaner see that the shuffle files of jobs that are over are no longer needed."""
    df.sparkSession.sparkContext._jvm.System.gc()


def slice_of_row() -> Column:
    """The slice of a row of the documents: that of its block of 1,000 rows of a file."""
    return F.pmod(F.xxhash64(F.regexp_replace("locator", r"\d{1,3}$", "")), F.lit(SLICES))


def slice_of_file(table: DataFrame) -> Column:
    """The slice of a row of a stored table: that of its file, by which the scan of a group leaves the other files out."""
    name = table.metadataColumn("_metadata").getField("file_name")
    return F.pmod(F.regexp_extract(name, r"part-(\d+)", 1).cast("long"), F.lit(SLICES))


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(hash, varied, n, slices) of the anchors of two phrases or more in all texts; varied: not all of these phrases are equal; slices: as bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", CHUNK_BYTES):
                first, _, anchor, phrase = phrases(data, offsets, length)
                bits = np.left_shift(1, rows.column("slice").to_numpy())[np.searchsorted(offsets, first, "right") - 1]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(phrase.view(np.int64)), pa.array(bits)], ["hash", "phrase", "bits"])

    found = docs.select("text", slice_of_row().alias("slice")).mapInArrow(tx.tidy(count), "hash long, phrase long, bits long")
    counted = found.groupBy("hash").agg(F.count("*").alias("n"), F.min("phrase").alias("low"), F.max("phrase").alias("high"), F.bit_or("bits").alias("slices"))
    return counted.filter("n > 1").select("hash", (F.col("low") != F.col("high")).alias("varied"), "n", "slices")


def groups_for(many: DataFrame) -> int:
    """How many groups the slices make, for the places of all hashes."""
    places = many.agg(F.sum("n")).first()[0] or 0
    return max(1, min(SLICES, -(-places // GROUP_PLACES)))


def inside(many: DataFrame, group: int, groups: int) -> DataFrame:
    """The hashes that stand in a group of slices."""
    return many.filter(F.col("slices").bitwiseAND(F.lit(sum(1 << k for k in range(group, SLICES, groups)))) != 0)


def bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with two bits for each hash, placed by its low bits and by those above them."""
    both = [F.pmod(F.shiftrightunsigned("hash", shift), F.lit(1 << FILTER_BITS)) + 1 for shift in (0, FILTER_BITS)]  # these functions count from 1
    place = F.col("place")
    blocks = hashes.select(F.explode(F.array(*both)).alias("place")).groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for block, bits in blocks.toLocalIterator():  # at most 2**FILTER_BITS / 32768 rows of 4 KB
        out[(block - 1) * 4096 : block * 4096] = np.frombuffer(bits, np.uint8)
    return out


def in_groups(groups: int, held: Callable[[int], list[DataFrame]], work: Callable[..., DataFrame], name: str) -> DataFrame:
    """`work(group, *bitmaps)` of one group after the other, written as one table; `held` gives the hashes that the bitmaps of a group have."""
    path = None
    for group in range(groups):
        hashes = held(group)
        context = hashes[0].sparkSession.sparkContext
        shared = [context.broadcast(bitmap(some)) for some in hashes]
        rows = work(group, *shared)
        path = path or scratch_path(rows.sparkSession, name)
        rows.write.mode("append").parquet(path)
        for one in shared:
            one.destroy()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def among(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has both bits of each hash."""
    out = np.ones(len(hashes), bool)
    for shift in (0, FILTER_BITS):
        some = np.flatnonzero(out)
        place = (hashes[some] >> np.uint64(shift) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
        out[some] = (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
    return out


def pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray, given: np.ndarray) -> pa.Array:
    """The bytes of each span that is given, null for the others."""
    raw = data.tobytes()
    return pa.array([raw[a:b] if on else None for a, b, on in zip(begin.tolist(), end.tolist(), given.tolist())], pa.binary())


# doc: a number of the row of the documents; start: first window; size: windows; body: their bytes, where they may have to be compared
RUNS = "doc long, start long, size long, doc_id long, hash long, body binary"


def repeated_phrases(docs: DataFrame, repeated: Broadcast, varied: Broadcast, length: int) -> DataFrame:
    """The phrases of repeated anchors as runs, with bodies if the anchor has different ones. Rows with a locator say which row a doc is."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RUNS.split(", ")] + ["locator"]
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", CHUNK_BYTES):
                first, size, anchor, phrase = phrases(data, offsets, length)
                kept = among(repeated.value, anchor)
                first, size, anchor, phrase = first[kept], size[kept], anchor[kept], phrase[kept]
                if len(first):
                    text = np.searchsorted(offsets, first, "right") - 1
                    bodies = pieces(data, first, first + size + length - 1, among(varied.value, anchor))
                    doc, doc_id = (rows.column(c).cast(pa.int64()).take(pa.array(text)) for c in ("doc", "doc_id"))
                    columns = [doc, pa.array(first - offsets[text]), pa.array(size), doc_id, pa.array(phrase.view(np.int64)), bodies]
                    yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(first), pa.string())], names)
                    some = pa.array(np.unique(text))
                    nothing = [pa.nulls(len(some), c.type) for c in columns[1:]]
                    yield pa.RecordBatch.from_arrays([rows.column("doc").take(some), *nothing, rows.column("locator").cast(pa.string()).take(some)], names)

    return docs.select("doc", "doc_id", "text", "locator").mapInArrow(tx.tidy(give), RUNS + ", locator string")


def folded(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, start, size) of the runs whose bytes also stand earlier; the other runs that have a body, with their slice."""
    rounds = max(1, min(FOLD_ROUNDS, -(-runs.count() // FOLD_ROWS)))
    path = None
    for k in range(rounds):
        # equal bytes meet in one round, and the shuffles of a round go before the next
        some = runs.filter(F.pmod(F.shiftright("hash", 32), F.lit(rounds)) == k) if rounds > 1 else runs
        firsts = stored(first_runs(some), "firsts")
        free(runs)
        both = told_by(some, firsts)
        path = path or scratch_path(runs.sparkSession, "told")
        both.write.mode("append").parquet(path)
        drop(firsts)
        free(runs)
    told = runs.sparkSession.read.schema(both.schema).parquet(path)
    later, left = told.filter("later"), told.filter("not later")
    return stored(later.select("doc", "start", "size"), "later"), left.select("doc", "start", "size", "doc_id", "body", slice_of_file(told).alias("slice"))


def first_runs(runs: DataFrame) -> DataFrame:
    """(of, first_doc, first_start, n): the first of the runs with one hash, where there are several."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "start")
    counted = runs.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return counted.select(F.col("hash").alias("of"), F.col("first.doc").alias("first_doc"), F.col("first.start").alias("first_start"), "n")


def told_by(runs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc, start, size, doc_id, body, later) of the runs that are not the first of their hash (no body), and of the others that have a body."""
    total = firsts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_KEYS > total
    often = F.broadcast(firsts.filter(hot))  # fewer than HOT_KEYS rows
    same = F.col("hash") == F.col("of")
    later = F.col("of").isNotNull() & ((F.col("doc") != F.col("first_doc")) | (F.col("start") != F.col("first_start")))

    def told(some: DataFrame, known: DataFrame) -> DataFrame:
        joined = some.join(known, same, "left").filter(later | F.col("body").isNotNull())
        return joined.select("doc", "start", "size", "doc_id", F.when(~later, F.col("body")).alias("body"), later.alias("later"))

    rare = runs.join(often, same, "left_anti")
    return told(runs.join(often, same, "left_semi"), often).unionByName(told(rare, firsts.filter(~hot)))


def bodies(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs with their bytes end to end and the offsets of these."""
    for begin in range(0, batch.num_rows, 1 << 13):
        rows = batch.slice(begin, 1 << 13)
        held = rows.column("body").to_pylist()
        yield rows, np.frombuffer(b"".join(held), np.uint8), np.append(0, np.cumsum([len(x) for x in held]))


def repeated_windows(runs: DataFrame, length: int) -> DataFrame:
    """(hash, n, slices) of the windows that stand in two runs or more; slices: as bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in bodies(batch):
                found = place_hashes(data, length)
                whole = np.arange(len(found)) + length <= np.repeat(offsets[1:], np.diff(offsets))[: len(found)]
                bits = np.repeat(np.left_shift(1, rows.column("slice").to_numpy()), np.diff(offsets))[: len(found)]
                yield pa.RecordBatch.from_arrays([pa.array(found[whole].view(np.int64)), pa.array(bits[whole])], ["hash", "bits"])

    found = runs.select("body", "slice").mapInArrow(tx.tidy(count), "hash long, bits long")
    return found.groupBy("hash").agg(F.count("*").alias("n"), F.bit_or("bits").alias("slices")).filter("n > 1")


def passing(data: np.ndarray, offsets: np.ndarray, held: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each place whether a window begins there that may be repeated, and the window hashes."""
    hashes = np.append(place_hashes(data, length), np.zeros(min(len(data), length - 1), np.uint64))
    whole = np.arange(len(data)) + length <= np.repeat(offsets[1:], np.diff(offsets))
    return whole & among(held, hashes), hashes


def narrowed(runs: DataFrame, held: Broadcast, length: int) -> DataFrame:
    """The runs of windows that may be repeated within the given ones."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in bodies(batch):
                begin, end = tx.spans(passing(data, offsets, held.value, length)[0], offsets)
                run = np.searchsorted(offsets, begin, "right") - 1
                hashes = tx.span_hash(tx.sums(data), begin, end + (length - 1))
                start = rows.column("start").to_numpy()[run] + begin - offsets[run]
                columns = [rows.column("doc").take(pa.array(run)), pa.array(start), pa.array(end - begin), rows.column("doc_id").take(pa.array(run))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(hashes.view(np.int64)), pieces(data, begin, end + length - 1, np.ones(len(begin), bool))], [part.split()[0] for part in RUNS.split(", ")])

    return runs.drop("slice").mapInArrow(tx.tidy(give), RUNS)


PLACES = "s long, g long, t0 long, t1 long, t2 long, prefix long, doc long, start long, doc_id long"


def places(runs: DataFrame, group: int, groups: int, held: Broadcast, length: int, unit: int) -> DataFrame:
    """A row per window that may be repeated, and per place its comparison needs, of the runs of a group.

    s and g: string and place in it; t0, t1, t2: its symbol and the next two (0: none); prefix: the hash of `length` bytes if the window may
    be repeated.
    """

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in PLACES.split(", ")]
        number = (TaskContext.get().partitionId() * groups + group) << 30
        for batch in batches:
            for rows, data, offsets in bodies(batch):
                begins, prefix = passing(data, offsets, held.value, length)
                end = np.repeat(offsets[1:], np.diff(offsets))
                used = begins.copy()
                for step in range(unit, length, unit):
                    used[step:] |= begins[: len(begins) - step]
                used &= np.arange(len(data)) + unit <= end
                at = np.flatnonzero(used)
                used = np.append(used, np.zeros(2 * unit, bool))
                if len(at):
                    # odd numbers, so that the end of a string (0) equals no symbol
                    symbols = np.append(place_hashes(data, unit) >> np.uint64(1) | np.uint64(1), np.zeros(unit, np.uint64))
                    run = np.searchsorted(offsets, at, "right") - 1
                    inside, of = at - offsets[run], number + run
                    goes_on = [np.ones(len(at), bool)]  # a string of symbols ends where its next place is left out
                    for k in (1, 2):
                        goes_on.append(goes_on[-1] & used[at + k * unit] & (at + k * unit < end[at]))
                    triple = [np.where(on, symbols[np.minimum(at + k * unit, len(symbols) - 1)], np.uint64(0)).view(np.int64) for k, on in enumerate(goes_on)]
                    columns = [pa.array(of * unit + inside % unit), pa.array(inside // unit), *map(pa.array, triple), pa.array(prefix[at].view(np.int64), mask=~begins[at])]
                    start = rows.column("start").to_numpy()[run] + inside
                    yield pa.RecordBatch.from_arrays([*columns, rows.column("doc").take(pa.array(run)), pa.array(start), rows.column("doc_id").take(pa.array(run))], names)
                number += rows.num_rows

    return runs.drop("slice").mapInArrow(tx.tidy(give), PLACES)


def parts_of(rows: int) -> int:
    return max(8, -(-rows // ROWS_PER_PART))


def numbered(df: DataFrame, count: str, name: str) -> DataFrame:
    """A column counted within partitions (`part`, `count`) made to go on from one partition to the next."""
    ends = {r["part"]: r["most"] for r in df.groupBy("part").agg(F.max(count).alias("most")).collect()}  # a row per partition
    before, offsets = 0, []
    for part in sorted(ends):
        offsets.append((part, before))
        before += ends[part]
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, "part int, before long"))
    return df.join(table, "part").withColumn(name, F.col("before") + F.col(count)).drop("part", "before", count)


def names(sample: DataFrame, rows: int) -> DataFrame:
    """(s, g, rank): the dense rank of each triple, from 1."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, rank = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if batch.num_rows:
                triple = np.stack([batch.column(c).to_numpy() for c in ("t0", "t1", "t2")], 1)
                new = np.append(last is None or (triple[0] != last).any(), (triple[1:] != triple[:-1]).any(1))
                ranks = rank + np.cumsum(new)
                last, rank = triple[-1], int(ranks[-1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ranks), part, np.int32)), batch.column("s"), batch.column("g"), pa.array(ranks)], ["part", "s", "g", "local"])

    ranged = sample.select("s", "g", "t0", "t1", "t2").repartitionByRange(parts_of(rows), "t0").sortWithinPartitions("t0", "t1", "t2")
    local = stored(ranged.mapInArrow(tx.tidy(name), "part int, s long, g long, local long"), "names")
    named = stored(numbered(local, "local", "rank"), "named")
    drop(local)
    free(named)
    return named


def follow(df: DataFrame, ranks: DataFrame) -> DataFrame:
    """The rows with the ranks of their own place, the next and the one after; 0 if there is none."""
    for k, column in enumerate(("r0", "r1", "r2")):
        df = df.join(ranks.select("s", (F.col("g") - k).alias("g"), F.col("rank").alias(column)), ["s", "g"], "left").fillna(0, [column])
    return df


def merged(columns: dict[str, np.ndarray]) -> np.ndarray:
    """The order of all suffixes, from the sample's ranks and the symbols of the others."""
    kind = columns["g"] % 3
    sample, rest = np.flatnonzero(kind), np.flatnonzero(kind == 0)
    sample = sample[np.argsort(columns["r0"][sample], kind="stable")]
    # ranks may tie beyond the needed depth; the rank after next keeps the order the same against both kinds of the sample
    rest = rest[np.lexsort((columns["r2"][rest], columns["r1"][rest], columns["t0"][rest]))]
    before = np.zeros(len(rest), np.int64)
    for of, keys in ((1, ("t0", "r1")), (2, ("t0", "t1", "r2"))):
        own = sample[kind[sample] == of]
        both = np.concatenate((own, rest))
        order = np.lexsort([columns[k][both] for k in reversed(keys)])
        new = np.zeros(len(both), bool)
        for k in keys:
            new[1:] |= columns[k][both[order]][1:] != columns[k][both[order]][:-1]
        place = np.empty(len(both), np.int64)
        place[order] = np.cumsum(new)
        before += np.searchsorted(place[: len(own)], place[len(own) :], "left")
    # beyond the needed depth ranks are arbitrary, so both kinds may place suffixes that are equal up to there in different orders
    before = np.maximum.accumulate(before)
    out = np.empty(len(kind), np.int64)
    out[np.arange(len(rest)) + before] = rest
    out[np.arange(len(sample)) + np.searchsorted(before, np.arange(len(sample)), "right")] = sample
    return out


def in_order(df: DataFrame, rows: int, work, schema: str) -> DataFrame:
    """`work` over the columns of each range of first symbols, in the order of the suffixes."""
    fields = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        held = pa.Table.from_batches(found) if found else None
        if held is not None and held.num_rows:
            columns = {c: held.column(c).fill_null(0).to_numpy() for c in fields}
            given = {c: ~held.column(c).is_null().to_numpy() for c in ("prefix", "doc_id") if c in fields}
            yield work(columns, given, merged(columns))

    return df.repartitionByRange(parts_of(rows), "t0").mapInArrow(tx.tidy(run), schema)


def ranked(rows: DataFrame, depth: int) -> DataFrame:
    """(s, g, rank) of all suffixes of the strings (s, g, t0, t1, t2) by their first `depth` symbols or more."""
    ranks = sample_ranks(rows, depth)
    count = rows.count()

    def rank(columns, _, order):
        part = np.full(len(order), TaskContext.get().partitionId(), np.int32)
        new = np.ones(len(order), bool)
        new[1:] = np.any([columns[k][order][1:] != columns[k][order][:-1] for k in ("t0", "t1", "t2", "r1", "r2")], 0)
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array(columns["s"][order]), pa.array(columns["g"][order]), pa.array(np.cumsum(new))], ["part", "s", "g", "local"])

    full = stored(follow(rows.select("s", "g", "t0", "t1", "t2"), ranks), "followed")
    return numbered(stored(in_order(full, count, rank, "part int, s long, g long, local long"), "ranked"), "local", "rank")


def sample_ranks(rows: DataFrame, depth: int) -> DataFrame:
    """(s, g, rank) of the sampled suffixes: names of triples, or the ranks of the strings of names if triples don't tell enough."""
    sample = rows.filter("g % 3 <> 0")
    count = sample.count()
    named = names(sample, count)
    if depth <= 3 or named.agg(F.max("rank")).first()[0] in (None, count):
        return named
    turned = named.select((F.col("s") * 2 + F.col("g") % 3 - 1).alias("s"), F.floor(F.col("g") / 3).alias("g"), F.col("rank").alias("t0"))
    for k in (1, 2):
        turned = turned.join(turned.select("s", (F.col("g") - k).alias("g"), F.col("t0").alias(f"t{k}")), ["s", "g"], "left").fillna(0, [f"t{k}"])
    deeper = ranked(stored(turned, "names-of-names"), -(-depth // 3))
    back = F.pmod("s", F.lit(2))
    return stored(deeper.select(F.shiftright("s", 1).alias("s"), (F.col("g") * 3 + 1 + back).alias("g"), "rank"), "sample-ranks")


def later_windows(rows: DataFrame, depth: int) -> DataFrame:
    """(doc, start, size) of the windows that the suffix array of all places finds to stand earlier as well. Deletes the places."""
    ranks = sample_ranks(rows.select("s", "g", "t0", "t1", "t2"), depth)

    def compare(columns, given, order):
        order = order[given["prefix"][order]]
        prefix = columns["prefix"][order]
        group = np.cumsum(np.append(True, prefix[1:] != prefix[:-1])[: len(prefix)])
        earliest = np.lexsort((columns["start"][order], columns["doc"][order], columns["doc_id"][order], ~given["doc_id"][order], group))
        later = np.append(False, group[earliest][1:] == group[earliest][:-1])[: len(order)]
        chosen = order[earliest[later]]
        return pa.RecordBatch.from_arrays([pa.array(columns["doc"][chosen]), pa.array(columns["start"][chosen]), pa.array(np.ones(len(chosen), np.int64))], ["doc", "start", "size"])

    full = stored(follow(rows, ranks), "followed")
    drop(rows, ranks)
    free(full)
    return in_order(full, full.count(), compare, "doc long, start long, size long")


def phrases_in_groups(docs: DataFrame, length: int) -> DataFrame:
    """The phrases of repeated anchors of all documents, and the locators of these."""
    many = stored(repeated_anchors(docs, length), "anchors")
    free(docs)
    groups = groups_for(many)
    # numbers in the order of the scan, whatever the groups
    docs = docs.withColumn("doc", F.monotonically_increasing_id())
    # else each group would read all texts
    dealt = stored(docs.withColumn("group", slice_of_row() % groups), "dealt", partitionBy="group") if groups > 1 else None

    def work(group: int, repeated: Broadcast, varied: Broadcast) -> DataFrame:
        return repeated_phrases(docs if dealt is None else dealt.filter(F.col("group") == group), repeated, varied, length)

    def held(group: int) -> list[DataFrame]:
        some = inside(many, group, groups)
        return [some, some.filter("varied")]

    found = in_groups(groups, held, work, "phrases")
    drop(many)
    if dealt is not None:
        drop(dealt)
    free(docs)
    return found


def windows_in_groups(runs: DataFrame, work: Callable[..., DataFrame], length: int, name: str) -> DataFrame:
    """`work(runs, group, groups, bitmap)` of the runs of each group; the bitmap has the windows there that stand in two runs or more. Deletes the runs."""
    many = stored(repeated_windows(runs, length), "windows")
    free(runs)
    groups = groups_for(many)
    made = in_groups(groups, lambda group: [inside(many, group, groups)], lambda group, held: work(runs.filter(F.col("slice") % groups == group), group, groups, held), name)
    drop(many, runs)
    return made


def repeats(docs: DataFrame, length: int = 100, unit: int = 50) -> DataFrame:
    """(locator, begins, ends): the maximal runs of bytes covered by strings of `length` bytes that also start earlier."""
    if length % unit or length % 2:
        raise ValueError("length must be even and a multiple of unit")
    found = phrases_in_groups(docs, length)
    rows_of = stored(found.filter("locator is not null").select("doc", "locator"), "rows")
    whole, left = folded(found.filter("locator is null").drop("locator"))
    drop(found)
    runs = windows_in_groups(left, lambda some, group, groups, held: narrowed(some, held, length), length, "runs")
    partly, left = folded(runs)
    drop(runs)
    rows = windows_in_groups(left, lambda some, group, groups, held: places(some, group, groups, held, length, unit), length, "places")
    starts = whole.unionByName(partly).unionByName(later_windows(rows, length // unit))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = begin = end = None
        for batch in batches:
            out = []
            for d, a, n in zip(*(batch.column(c).to_pylist() for c in ("doc", "start", "size"))):
                if d == doc and a <= end:
                    end = max(end, a + n - 1 + length)
                else:
                    if doc is not None:
                        out.append((doc, begin, end))
                    doc, begin, end = d, a, a + n - 1 + length
            yield pa.RecordBatch.from_pylist([dict(zip(("doc", "begin", "end"), x)) for x in out], pa.schema([(c, pa.int64()) for c in ("doc", "begin", "end")]))
        if doc is not None:
            yield pa.RecordBatch.from_pylist([{"doc": doc, "begin": begin, "end": end}])

    spans = starts.repartition("doc").sortWithinPartitions("doc", "start").mapInArrow(tx.tidy(join_up), "doc long, begin long, end long")
    of_doc = spans.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    out = stored(of_doc.join(rows_of, "doc").select("locator", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends")), "spans")
    drop(starts, rows_of)
    return out


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) and kept_sha256 for every document."""
    rows = located(docs)
    spans = repeats(rows, **options)
    spans = spans.withColumnRenamed("locator", "of")
    count, runs = spans.agg(F.count("*"), F.sum(F.size("begins"))).first()
    if count <= BROADCAST_SPANS and (runs or 0) <= BROADCAST_RUNS:
        spans = F.broadcast(spans)
    joined = rows.join(spans, F.col("locator") == F.col("of"), "left").select("doc_id", "text", "begins", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for text, begins, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "begins", "ends"))):
                raw, begins, ends = (text or "").encode(), begins or [], ends or []
                kept = b"".join(raw[a:b] for a, b in zip([0, *ends], [*begins, len(raw)]))
                for column, value in zip(out, (len(raw), len(raw) - len(kept), len(begins), kept, hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *map(pa.array, out, kinds)], names)

    return joined.mapInArrow(tx.tidy(cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
