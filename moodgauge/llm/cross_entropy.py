"""Language-model scoring by the difference of cross-entropies.

Two bigram models of one kind, over one vocabulary: a target model of good documents and a background model of all documents.
A document's score is the mean over its tokens of (loss under the target - loss under the background); lower is nearer the target.

Counts are taken over all documents, and the target's over all that are labelled good and not held out. The vocabulary holds the words
found twice or more, both models the pairs found twice or more; the rest is <unk>, or left to the unigrams. So the models grow with the
corpus, and a word or pair is kept by its own count at every size of it. Losses are interpolated: a discounted pair plus the mass left
for its first word times the smoothed unigram.

The models are tables in buckets of their keys, about one for 8 MB of text. Texts are read once, as numbers of the distinct words of their
chunk. Words, pairs, their counts and what is asked of the models travel as lists, of at most LIST numbers of one bucket, so a
shuffle moves few rows and numpy sums and looks up a bucket at a time. A chunk asks for its distinct words and pairs, and what is
found goes back to the chunk, a bounded group of texts; so a word or pair of any frequency costs one entry per chunk and a bucket
holds a like share of all entries. The most frequent entries of the models, of a fixed number, are broadcast and are not asked for;
pairs that are in no model are told by a bitmap of fixed size first, which may let more through but never fewer. `least=1`
keeps every word and pair.

Defined cases: a null or empty text has no token and the losses and the score 0; without target rows the target model is the
smoothed vocabulary alone; rows that repeat count each; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.labelled import label_rows
from moodgauge.llm.suffixes import among, bitmap, free
from moodgauge.llm.tables import drop, small, stored

RAREST = 0.0  # share of all tokens that a word or pair must have besides its count
LEAST = 2.0
DISCOUNT = 0.75
SMOOTHING = 0.5
HELD_KEYS = 1 << 20
CHUNK_BYTES = 4 << 20
TEXT_ROWS = 512
BROADCAST_IDS = 1 << 20
# the most frequent words and pairs of the models, at most so many, are broadcast; all others are joined
HEAD_KEYS = 1 << 19
MOST_COUNT = 1 << 16
BUCKET_BYTES = 8 << 20
LIST = 512
SHIFT = np.uint64(32)
TEXTS = "part long, doc_id long, is_target boolean, tokens binary"
WORDS = "bucket int, keys binary, at binary, n binary, target binary"
NAMED = "part long, at binary, ids binary, bucket int, n binary, target binary, size long, all_n long, all_target long"
COUNTED = "bucket int, keys binary, n binary, target binary"
USED = "firsts binary, n_used binary, target_used binary"
MODELS = "bucket int, keys binary, n binary, target binary, n_used binary, target_used binary"
LOSSES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word in lower case, and how many words each text has."""
    lowered = tx.LOWER[data]
    begin, end, at = tx.words(lowered, offsets)
    return tx.span_hash(tx.sums(lowered), begin, end), np.diff(at)


KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def batch_of(schema: str, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of a schema; columns that are not given are null."""
    count = len(next(iter(columns.values())))
    kinds = dict(part.split() for part in schema.split(", "))
    return pa.RecordBatch.from_arrays([columns[c].cast(KINDS[k]) if c in columns else pa.nulls(count, KINDS[k]) for c, k in kinds.items()], list(kinds))


def as_lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Values between one end and the next, as binary values."""
    ends, values = (ends * values.itemsize).astype(np.int32), np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def by_bucket(buckets: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Rows of at most LIST values of one bucket: the bucket, and a list of each column."""
    order = np.argsort(buckets, kind="stable")
    own, place = buckets[order], np.arange(len(order))
    begin = np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1])[: len(own)], place, 0))
    cuts = np.flatnonzero((place - begin) % LIST == 0)
    ends = np.append(cuts, len(own))
    return [pa.array(own[cuts].astype(np.int32)), *(as_lists(x[order], ends) for x in columns)]


def in_row(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all lists end to end."""
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind)


def sums_of(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys, the place of each key among them, and their sums."""
    own, back = np.unique(keys, return_inverse=True)
    return own, back, [np.bincount(back, x, len(own)).astype(np.int64) for x in columns]


def word_buckets(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ids % buckets


def key_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (tx.mix(keys) % np.uint64(buckets)).astype(np.int64)


def listed(tokens: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The numbers of each text as a binary value."""
    ends = np.append(0, np.cumsum(counts)).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(tokens.astype(np.uint32))])


def unlisted(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    held = column.to_pylist()
    return np.frombuffer(b"".join(held), np.uint32).astype(np.int64), np.array([len(x) // 4 for x in held], np.int64)


def pair_keys(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs begin, and their keys: first id << 32 | second id."""
    places, _ = tx.whole_windows(counts, 2)
    return places, tokens[places].astype(np.uint64) << SHIFT | tokens[places + 1].astype(np.uint64)


class Counts:
    """Sums of keys over the texts of a task: how often in all, and how often in the target."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.parts: list[tuple] = []
        self.held = 0

    def add(self, keys: np.ndarray, in_target: np.ndarray) -> None:
        own, back, count = np.unique(keys, return_inverse=True, return_counts=True)
        self.parts.append((own, count, np.bincount(back, in_target, len(own)).astype(np.int64)))
        self.held += len(own)

    def take(self) -> pa.RecordBatch:
        own, _, sums = sums_of(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays(by_bucket(key_buckets(own, self.buckets), own, *sums), names_of(COUNTED))


def in_chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """A row per text, with the places of its words in its chunk's list, and rows for the words of that list. docs: doc_id, text, is_target."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, part = f"{TEXTS}, {WORDS}", TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", CHUNK_BYTES):
                hashes, counts = hashed_words(data, offsets)
                own, back, n = np.unique(hashes, return_inverse=True, return_counts=True)
                in_target = np.repeat(rows.column("is_target").to_numpy(zero_copy_only=False), counts)
                target = np.bincount(back, in_target, len(own)).astype(np.int64)
                yield batch_of(schema, part=pa.array(np.full(len(counts), part)), doc_id=rows.column("doc_id"), is_target=rows.column("is_target"), tokens=listed(back, counts))
                of_words = by_bucket(key_buckets(own, buckets), own, np.arange(len(own), dtype=np.int32), n.astype(np.int64), target)
                yield batch_of(schema, part=pa.array(np.full(len(of_words[0]), part)), **dict(zip(names_of(WORDS), of_words)))
                part += 1

    return docs.select("doc_id", "text", "is_target").mapInArrow(tx.tidy(give), f"{TEXTS}, {WORDS}")


def with_numbers(read: DataFrame, buckets: int, least: float) -> DataFrame:
    """The vocabulary by bucket, with ids from 1 x buckets on (0 is <unk>), the ids of each chunk's words that are in it, and totals."""

    def name(rows: pa.Table) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        own, back, (n, target) = sums_of(in_row(rows["keys"], np.uint64), in_row(rows["n"], np.int64), in_row(rows["target"], np.int64))
        kept = n >= least
        ids = np.where(kept, np.cumsum(kept) * buckets + bucket, 0)
        if ids.max(initial=0) >> 31:
            raise OverflowError("the vocabulary has more words than ids")
        at, sizes = in_row(rows["at"], np.int32), np.array([len(x) // 4 for x in rows["at"].to_pylist()], np.int64)
        known = kept[back]
        ends = np.append(0, np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[known], minlength=len(sizes))))
        of_chunks = batch_of(NAMED, part=rows["part"].combine_chunks(), at=as_lists(at[known], ends), ids=as_lists(ids[back][known].astype(np.uint32), ends))
        of_words = by_bucket(np.full(kept.sum(), bucket), ids[kept].astype(np.uint32), n[kept], target[kept])
        totals = batch_of(NAMED, **{c: pa.array([int(x)]) for c, x in (("size", kept.sum()), ("all_n", n[kept].sum()), ("all_target", target[kept].sum()))})
        out = pa.Table.from_batches([of_chunks, batch_of(NAMED, **dict(zip(("bucket", "ids", "n", "target"), of_words))), totals])
        tx.give_back()
        return out

    return read.filter("bucket is not null").select("part", *names_of(WORDS)).groupBy("bucket").applyInArrow(name, NAMED)


def with_ids(texts: DataFrame, named: DataFrame) -> DataFrame:
    """The texts with the ids of the vocabulary for places in a list; 0 for words it does not have."""

    def change(left: pa.Table, right: pa.Table) -> pa.Table:
        at, counts = unlisted(left["tokens"])
        ids = np.zeros(at.max(initial=-1) + 1, np.int64)
        if left.num_rows:
            ids[in_row(right["at"], np.int32)] = in_row(right["ids"], np.uint32)
        out = pa.Table.from_arrays([left["part"], left["doc_id"], left["is_target"], listed(ids[at], counts)], names_of(TEXTS))
        tx.give_back()
        return out

    known = named.filter("part is not null").select(F.col("part").alias("chunk"), "at", "ids")
    return texts.filter("tokens is not null").select(*names_of(TEXTS)).groupBy("part").cogroup(known.groupBy("chunk")).applyInArrow(change, TEXTS)


def counted_pairs(texts: DataFrame, buckets: int) -> DataFrame:
    """How often pairs of ids are found, as lists by bucket; each task sums its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Counts(buckets)
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXT_ROWS):
                rows = batch.slice(begin, TEXT_ROWS)
                tokens, counts = unlisted(rows.column("tokens"))
                places, keys = pair_keys(tokens, counts)
                own.add(keys, np.repeat(rows.column("is_target").to_numpy(zero_copy_only=False), counts)[places])
                if own.held > HELD_KEYS:
                    yield own.take()
                    tx.give_back()
        if own.held:
            yield own.take()

    return texts.select("is_target", "tokens").mapInArrow(tx.tidy(count), COUNTED)


def kept_pairs(counted: DataFrame, buckets: int, least: float, least_target: float) -> DataFrame:
    """The pairs of the models by bucket, and what each bucket's pairs add to the discounted sums of their first words."""

    def add(rows: pa.Table) -> pa.Table:
        own, _, (n, target) = sums_of(in_row(rows["keys"], np.uint64), in_row(rows["n"], np.int64), in_row(rows["target"], np.int64))
        kept = (n >= least) | (target >= least_target)
        own, n, target = own[kept], n[kept], target[kept]
        first, back = np.unique((own >> SHIFT).astype(np.int64), return_inverse=True)
        used = [np.bincount(back, np.maximum(x - DISCOUNT, 0), len(first)).astype(np.float64) for x in (n, target)]
        schema = f"{COUNTED}, {USED}"
        of_pairs = by_bucket(np.full(len(own), rows["bucket"][0].as_py()), own, n, target)
        of_firsts = by_bucket(word_buckets(first, buckets), first, *used)
        out = pa.Table.from_batches([batch_of(schema, **dict(zip(names_of(COUNTED), of_pairs))), batch_of(schema, **dict(zip(["bucket", *names_of(USED)], of_firsts)))])
        tx.give_back()
        return out

    return counted.groupBy("bucket").applyInArrow(add, f"{COUNTED}, {USED}")


def word_models(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """The models' words (-1 - id) by bucket: counts, and the discounted sums of their pairs. words: bucket, ids, n, target."""

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, n, target = (in_row(left[c], k) for c, k in (("ids", np.uint32), ("n", np.int64), ("target", np.int64)))
        own, back = np.unique(in_row(right["firsts"], np.int64), return_inverse=True)
        used = np.zeros((2, len(ids)))
        known, spot = found_in(own, ids.astype(np.int64))
        for row, c in zip(used, names_of(USED)[1:]):
            row[known] = np.bincount(back, in_row(right[c], np.float64), len(own))[spot]
        lists = by_bucket(np.full(len(ids), left["bucket"][0].as_py() if left.num_rows else 0), -1 - ids.astype(np.int64), n, target, *used)
        return pa.Table.from_arrays(lists, names_of(MODELS))

    used = pairs.filter("firsts is not null").select(F.col("bucket").alias("of"), *names_of(USED))
    return words.groupBy("bucket").cogroup(used.groupBy("of")).applyInArrow(gather, MODELS)


def mixed(pairs: DataFrame, cut: int) -> DataFrame:
    """(hash) of the keys found less than `cut` times, as a bitmap tells them."""

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = in_row(batch.column("keys"), np.uint64)[in_row(batch.column("n"), np.int64) < cut]
            yield pa.RecordBatch.from_arrays([pa.array(tx.mix(keys).view(np.int64))], ["hash"])

    return pairs.select("keys", "n").mapInArrow(tx.tidy(mix), "hash long")


def frequent(models: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """The count from which at most HEAD_KEYS entries of the models are, and these: keys, ascending, and their four columns."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, count = np.unique(np.minimum(in_row(batch.column("n"), np.int64), MOST_COUNT), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(count)], ["n", "entries"])

    counted = models.select("n").mapInArrow(tx.tidy(tell), "n long, entries long").groupBy("n").agg(F.sum("entries"))
    cut, held = MOST_COUNT + 1, 0
    for n, count in sorted(counted.collect(), reverse=True):  # at most MOST_COUNT + 1 rows
        held += count
        if held > HEAD_KEYS:
            break
        cut = n

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, columns = entries(batch)
            often = (columns[1] >= cut) & (cut <= MOST_COUNT)
            yield pa.RecordBatch.from_arrays([pa.array(x[often]) for x in (keys, *columns)], ["key", "target", "n", "target_used", "n_used"])

    head = models.mapInArrow(tx.tidy(take), "key long, target double, n double, target_used double, n_used double").toArrow()
    return cut, by_key(head["key"].to_numpy(), np.stack([head[c].to_numpy() for c in head.column_names[1:]]))


def entries(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The keys of lists of the models, and their four columns; pairs have no discounted sums."""
    keys = rows.column("keys")
    held = keys.to_pylist()
    used = (np.frombuffer(b"".join(x or bytes(len(k)) for x, k in zip(rows.column(c).to_pylist(), held)), np.float64) for c in ("target_used", "n_used"))
    return in_row(keys, np.int64), np.stack([in_row(rows.column("target"), np.int64), in_row(rows.column("n"), np.int64), *used]).astype(np.float64)


def by_key(keys: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], columns[:, order]


def found_in(held: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among the held ones, and the places of these."""
    spot = np.searchsorted(held, keys)
    known = spot < len(held)
    known[known] = held[spot[known]] == keys[known]
    return known, spot[known]


def values(tables: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The four columns of each key in one of the tables, and whether it is in any."""
    out, any_known = np.zeros((4, len(keys))), np.zeros(len(keys), bool)
    for held, columns in tables:
        known, spot = found_in(held, keys)
        out[:, known] = columns[:, spot]
        any_known |= known
    return out, any_known


def wanted(texts: DataFrame, held: np.ndarray, head: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, part, keys) of the words (-1 - id) and pairs of each chunk, apart, without those of the head and pairs the bitmap does not have."""
    shared = texts.sparkSession.sparkContext.broadcast((held, head))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head = shared.value
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for part in np.unique(parts):
                tokens, counts = unlisted(batch.column("tokens").filter(pa.array(parts == part)))
                pairs = np.unique(pair_keys(tokens, counts)[1])
                pairs = pairs[among(held, tx.mix(pairs))]
                words = np.unique(tokens)
                for of, keys in ((word_buckets(words, buckets), -1 - words), (key_buckets(pairs, buckets), pairs.view(np.int64))):
                    rarer = ~found_in(head, keys)[0]
                    lists = by_bucket(of[rarer], keys[rarer])
                    yield pa.RecordBatch.from_arrays([lists[0], pa.array(np.full(len(lists[0]), part)), lists[1]], ["bucket", "part", "keys"])

    return texts.select("part", "tokens").mapInArrow(tx.tidy(give), "bucket int, part long, keys binary")


def looked_up(asked: DataFrame, models: DataFrame) -> DataFrame:
    """The entries of the models that each chunk asks for, as lists."""
    fields = ["chunk", *names_of(MODELS)[1:]]

    def answer(asked: pa.Table, model: pa.Table) -> pa.Table:
        held, columns = by_key(*entries(model))
        keys, sizes = in_row(asked["keys"], np.int64), np.array([len(x) // 8 for x in asked["keys"].to_pylist()], np.int64)
        known, spot = found_in(held, keys)
        target, n, target_used, n_used = columns[:, spot]
        ends = np.append(0, np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[known], minlength=len(sizes))))
        lists = [as_lists(x, ends) for x in (keys[known], n.astype(np.int64), target.astype(np.int64), n_used, target_used)]
        # a list holds words or pairs; the sums of pairs are nothing, so they are left out
        of_pairs = pa.array(keys[np.cumsum(sizes) - 1] >= 0) if len(keys) else pa.array([], pa.bool_())
        lists[3:] = [pc.if_else(of_pairs, pa.scalar(None, pa.binary()), x) for x in lists[3:]]
        out = pa.Table.from_arrays([asked["part"], *lists], fields)
        tx.give_back()
        return out

    schema = MODELS.replace("bucket int", "chunk long")
    return asked.groupBy("bucket").cogroup(models.withColumnRenamed("bucket", "of").groupBy("of")).applyInArrow(answer, schema)


def losses(tokens: np.ndarray, counts: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], total: np.ndarray, room: int) -> np.ndarray:
    """Loss of each token under the target and the background, 2 x tokens; a text's first token has no pair.

    tables: counts in both models of the chunk's words and kept pairs and, for words, the discounted sums of their kept pairs; total: all
    tokens of both models, 2 x 1; room: the words and <unk>.
    """
    own, back = np.unique(tokens, return_inverse=True)
    of_words, _ = values(tables, -1 - own)
    chance = (of_words[:2] + SMOOTHING) / (total + SMOOTHING * room)
    begun = np.maximum(of_words[:2], 1)
    mass = np.clip(1 - of_words[2:] / begun, 1e-6, 1)
    out = -np.log(chance)[:, back]
    places, keys = pair_keys(tokens, counts)
    pairs, of = np.unique(keys, return_inverse=True)
    of_pairs, kept = values(tables, pairs.view(np.int64))
    first, second = (found_in(own, x.astype(np.int64))[1] for x in (pairs >> SHIFT, pairs & np.uint64(0xFFFFFFFF)))
    loss = -np.log(mass[:, first]) - np.log(chance[:, second])
    first, second = first[kept], second[kept]
    loss[:, kept] = -np.log(np.maximum(of_pairs[:2, kept] - DISCOUNT, 0) / begun[:, first] + mass[:, first] * chance[:, second])
    out[:, places + 1] = loss[:, of]
    return out


def scored(texts: DataFrame, found: DataFrame, head: tuple[np.ndarray, np.ndarray], total: np.ndarray, room: int) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and their difference, each the mean over tokens."""

    shared = texts.sparkSession.sparkContext.broadcast(head)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens, counts = unlisted(left["tokens"])
        text = np.repeat(np.arange(len(counts)), counts)
        mean = [np.bincount(text, row, len(counts)) / np.maximum(counts, 1) for row in losses(tokens, counts, [shared.value, by_key(*entries(right))], total, room)]
        out = pa.Table.from_arrays([left["doc_id"], pa.array(counts), *map(pa.array, mean), pa.array(mean[0] - mean[1])], names_of(LOSSES))
        tx.give_back()
        return out

    return texts.groupBy("part").cogroup(found.groupBy("chunk")).applyInArrow(score, LOSSES)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, column: str = "quality", rarest: float = RAREST, least: float = LEAST) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score for every document."""
    good = label_rows(labels, column).filter("label = 1").select("doc_id", F.lit(True).alias("is_target"))
    marked = docs.select("doc_id", "text").join(small(good, BROADCAST_IDS), "doc_id", "left").select("doc_id", "text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // BUCKET_BYTES + 1
    read = stored(in_chunks(marked, buckets), "chunks", compression="zstd")
    length = F.octet_length("tokens") / 4
    n, target = (int(x or 0) for x in read.agg(F.sum(length), F.sum(F.when(F.col("is_target"), length))).first())
    least, least_target = max(least, rarest * n), max(least, rarest * target)

    named = stored(with_numbers(read, buckets, least), "named", compression="zstd")
    size, of_words, of_target = (x or 0 for x in named.agg(F.sum("size"), F.sum("all_n"), F.sum("all_target")).first())
    texts = stored(with_ids(read, named), "texts", compression="zstd")
    drop(read)
    free(docs)
    counted = counted_pairs(texts, buckets)
    pairs = stored(kept_pairs(counted, buckets, least, least_target), "pairs", compression="zstd")
    free(docs)
    # <unk> stands for all words that are not in the vocabulary
    unknown = [(0, *(bytearray(np.array([x], k).tobytes()) for x, k in ((0, np.uint32), (n - of_words, np.int64), (target - of_target, np.int64))))]
    words = named.filter("bucket is not null").select("bucket", "ids", "n", "target").unionByName(docs.sparkSession.createDataFrame(unknown, "bucket int, ids binary, n binary, target binary"))
    of_pairs = pairs.filter("firsts is null").select(*names_of(MODELS))
    of_words = stored(word_models(words, pairs), "word-models", compression="zstd")
    models = of_words.unionByName(of_pairs)
    cut, head = frequent(models)
    held = bitmap(mixed(of_pairs, cut))
    drop(named)
    free(docs)
    found = stored(looked_up(wanted(texts, held, head[0], buckets), models), "looked-up", compression="zstd")
    drop(pairs, of_words)
    free(docs)
    out = stored(scored(texts, found, head, np.array([[target], [n]], np.float64), size + 1), "scores")
    drop(texts, found)
    return out
