"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

Each text, with a space before it, is encoded by a byte-level BPE (A) and a piece BPE with byte fallback (B). Tokens are laid end to
end, so a side is an ascending list of end offsets. Merging the two lists walks a grid from corner to corner; diagonals at equal
distances cut the walk into pieces of equal work, and a binary search along each diagonal finds where the walk crosses it. Each piece
merges its own parts of both lists and emits an overlap per end offset: the A token and the B token that cover the bytes before
it, and whether both end there. An offset at which both end may be cut by a diagonal; the piece before then leaves it to the one after.
Where both end a group ends, and the pieces' groups are stitched by counting these ends over all pieces.

A pair of ids (A, B) is linked once per pair of token occurrences that end together (`relation="end"`), or that share a byte ("overlap").
How often each pair is linked is counted over the corpus: tasks sum their own pairs first. The most frequent pairs, of a fixed number,
are broadcast to the documents; rarer ones, if there are more, are joined by Spark, and only their own documents are touched.

Neither tokenizer joins across a space that follows a visible letter or sign and precedes none, so texts are cut there and parts
encoded once per task. A part's tokens are checked against its bytes when it is first met.

Defined cases: a null or empty text, and one whose joined token bytes on either side differ from the text with its space (as U+2581 in the
text brings about), has no tokens: zeros and ''. Rows that repeat count each; a null doc_id stays null; further columns are
ignored; an empty table gives an empty result. A task holds one chunk of about 1 MB of text, or one longer text, at some 60 bytes a byte.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx
from moodgauge.llm.tables import drop, stored

CHUNK_BYTES = 1 << 20
PIECE = 1 << 14
KNOWN_PARTS = 300_000
COUNTED_PAIRS = 1 << 21
HEAD_PAIRS = 1 << 20
MOST_COUNT = 1 << 16
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
STORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"
SUMS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# tokens


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level BPE writes each byte: visible Latin-1 letters stand for themselves, the others follow U+0100 in turn."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Side A. `entries`: the bytes of each id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names inside texts are plain text
        letters, vocabulary = byte_letters(), self.tokenizer.get_vocab()
        self.entries = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.entries[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]


class PieceTokens:
    """Side B; it puts the first space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.tokenizer.id_to_piece(k) for k in range(self.tokenizer.get_piece_size())]
        self.entries = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self.tokenizer.encode([part[1:] for part in parts], num_threads=1)


class Side:
    """Token ids of the parts seen so far, end to end, and the length in bytes of each id."""

    def __init__(self, tokens: ByteTokens | PieceTokens):
        self.tokens = tokens
        self.lengths = np.array([len(x) for x in tokens.entries], np.int64)
        self.forget()

    def forget(self) -> None:
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def learn(self, parts: list[str], at: np.ndarray) -> np.ndarray:
        """Adds parts at places of the ordered list; False for each whose joined token bytes differ from it."""
        found = self.tokens.encode(parts)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)
        self.pool = np.concatenate((self.pool, np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum()))))
        entries = self.tokens.entries
        return np.array([b"".join([entries[i] for i in x]) == part.encode() for x, part in zip(found, parts)], bool)

    def of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts end to end, and how many each has."""
        sizes = self.sizes[place]
        begin = np.cumsum(sizes) - sizes
        return self.pool[np.arange(sizes.sum()) + np.repeat(self.starts[place] - begin, sizes)], sizes


class Parts:
    """Both sides of texts, with the parts that were met before kept by a 64-bit hash and their length."""

    def __init__(self, paths: tuple[str, str]):
        self.sides = (Side(ByteTokens(paths[0])), Side(PieceTokens(paths[1])))
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.exact = np.zeros(0, bool)
        for side in self.sides:
            side.forget()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Ids of each side and how many each text has; and which texts are equal to the bytes of both. Texts begin with a space."""
        begin = part_starts(data, offsets)
        end = np.append(begin[1:], len(data))
        keys = tx.mix(tx.span_hash(tx.sums(data), begin, end) + (end - begin).astype(np.uint64))
        if len(self.keys) > KNOWN_PARTS:
            self.forget()
        own, first, back = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, own)
        known = np.zeros(len(own), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == own[inside]
        if not known.all():
            new, at = first[~known], place[~known]
            raw = data.tobytes()
            parts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin[new].tolist(), end[new].tolist())]
            exact = np.logical_and(*(side.learn(parts, at) for side in self.sides))
            self.keys, self.exact = np.insert(self.keys, at, own[~known]), np.insert(self.exact, at, exact)
            place = np.searchsorted(self.keys, own)
        place = place[back]
        at = np.searchsorted(begin, offsets)
        texts = len(offsets) - 1
        text = np.repeat(np.arange(texts), np.diff(at))
        whole = np.bincount(text[~self.exact[place]], minlength=texts) == 0
        kept = whole[text]
        out = []
        for side in self.sides:
            ids, sizes = side.of(place[kept])
            out.append((ids, np.bincount(text[kept], sizes, texts).astype(np.int64)))
        return out, whole


VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = True


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts begin, and single spaces between a visible ASCII sign, or a letter from U+00C0 to U+024F, and something but a space."""
    space = data == 32
    letter = np.zeros(len(data), bool)
    letter[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xC9)
    cut = space.copy()
    cut[1:] &= (VISIBLE[data] | letter)[:-1]
    cut[:-1] &= ~space[1:]
    cut[-1:] = False
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each, empty ones left as they are."""
    some = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][some], 32), offsets + np.append(0, np.cumsum(some))


# merging


class Overlaps(NamedTuple):
    """Per end offset: places of the A and the B token that cover the byte before it, and whether both end there."""

    a: np.ndarray
    b: np.ndarray
    together: np.ndarray


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of a's ends lie before each diagonal of the merge; of equal ends a's comes first. All searches at once."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        ahead = np.zeros(len(diagonals), bool)  # a[middle] is merged before the diagonal
        ahead[open_] = a[middle[open_]] <= b[diagonals[open_] - middle[open_] - 1]
        low, high = np.where(open_ & ahead, middle + 1, low), np.where(open_ & ~ahead, middle, high)
    return low


def merged_piece(a: np.ndarray, b: np.ndarray, from_a: int, to_a: int, from_b: int, to_b: int) -> Overlaps:
    """The overlaps of one piece; an end of a that b's next piece shares is left to that piece."""
    ends = np.concatenate((a[from_a:to_a], b[from_b:to_b]))
    order = np.argsort(ends, kind="stable")
    of_b = order >= to_a - from_a
    ends = ends[order]
    # tokens that end before or at each place
    done_a, done_b = from_a + np.cumsum(~of_b), from_b + np.cumsum(of_b)
    same = np.append(ends[1:] == ends[:-1], len(ends) > 0 and to_b < len(b) and ends[-1] == b[to_b])
    last = ~same
    together = np.append(False, same[:-1])
    if from_a and len(ends) and from_b < len(b) and a[from_a - 1] == ends[0] and of_b[0]:
        together[0] = True
    ends_a, ends_b = ~of_b[last] | together[last], of_b[last]
    return Overlaps(done_a[last] - ends_a, done_b[last] - ends_b, together[last])


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Iterator[Overlaps]:
    """The overlaps of two ascending lists of ends with the same last one, piece by piece."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    of_a = crossings(a, b, diagonals)
    of_b = diagonals - of_a
    for k in range(len(diagonals) - 1):
        yield merged_piece(a, b, *(int(x) for x in (of_a[k], of_a[k + 1], of_b[k], of_b[k + 1])))


def stitched(pieces: Iterator[Overlaps]) -> Overlaps:
    held = list(pieces)
    return Overlaps(*(np.concatenate(x) for x in zip(*held))) if held else Overlaps(*np.zeros((2, 0), np.int64), np.zeros(0, bool))


# groups as text


def digits(most: int) -> np.ndarray:
    """Each number below `most` as decimal signs, filled with zero bytes before, with room for a sign after."""
    width = len(str(most - 1))
    out = np.zeros((most, width + 1), np.uint8)
    numbers = np.arange(most)
    for k in range(width):
        shown = (numbers >= 10**k) | (k == 0)
        out[shown, width - 1 - k] = 48 + numbers[shown] // 10**k % 10
    return out


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, figures: np.ndarray, per_text: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2` of each text. ends: tokens of the side up to the end of each group; per_text: tokens of both in each text."""
    a_of = np.repeat(np.arange(len(ends_a)), np.diff(ends_a, prepend=0))
    b_of = np.repeat(np.arange(len(ends_b)), np.diff(ends_b, prepend=0))
    place_a = np.arange(len(ids_a)) + (ends_b - np.diff(ends_b, prepend=0))[a_of]
    place_b = np.arange(len(ids_b)) + ends_a[b_of]
    shown = np.empty((len(ids_a) + len(ids_b), figures.shape[1]), np.uint8)
    shown[place_a], shown[place_b] = figures[ids_a], figures[ids_b]
    shown[:, -1] = 44
    shown[place_a[ends_a - 1], -1] = 124
    shown[place_b[ends_b - 1], -1] = 59
    used = (shown != 0).sum(axis=1)
    raw = shown[shown != 0].tobytes()
    upto = np.append(0, np.cumsum(used))[np.append(0, np.cumsum(per_text))].tolist()
    return [raw[begin : max(begin, end - 1)] for begin, end in zip(upto, upto[1:])]


# documents


def aligned(parts: Parts, data: np.ndarray, offsets: np.ndarray, relation: str, figures: np.ndarray) -> dict[str, np.ndarray | list]:
    """The stored columns of a chunk's texts, with its pairs end to end and how many pairs each text has."""
    data, offsets = with_space(data, offsets)
    texts, codes_b = len(offsets) - 1, len(parts.sides[1].tokens.entries)
    ((ids_a, n_a), (ids_b, n_b)), _ = parts.encode(data, offsets)
    ends_a, ends_b = (np.cumsum(side.lengths[ids]) for side, ids in zip(parts.sides, (ids_a, ids_b)))
    over = stitched(merge_path(ends_a, ends_b))
    text_of_a = np.repeat(np.arange(texts), n_a)
    groups_a, groups_b = over.a[over.together] + 1, over.b[over.together] + 1
    linked = over.together if relation == "end" else np.ones(len(over.a), bool)
    a, b = over.a[linked], over.b[linked]
    # within a chunk a text's number and a pair's code share one number
    code = text_of_a[a].astype(np.int64) << 31 | ids_a[a].astype(np.int64) * codes_b + ids_b[b]
    own, times = np.unique(code, return_counts=True)
    shown = group_texts(ids_a, ids_b, groups_a, groups_b, figures, n_a + n_b)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text_of_a[groups_a - 1], minlength=texts), "n_links": np.bincount(text_of_a[a], minlength=texts),
        "groups_sha256": [hashlib.sha256(x).hexdigest() if x else "" for x in shown],
        "pairs": (own & ((1 << 31) - 1)).astype(np.int32), "times": times.astype(np.int32), "n_pairs": np.bincount(own >> 31, minlength=texts),
    }


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values))


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None, relation: str = "end") -> DataFrame:
    """A row per document: its counts and digest, its distinct linked pairs (A id times B's vocabulary, plus B id), and how often each."""
    paths = paths or tokenizer_paths()
    names = [part.split()[0] for part in STORED.split(", ")]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, row = Parts(paths), TaskContext.get().partitionId() << 40
        figures = digits(max(len(side.tokens.entries) for side in parts.sides))
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text", CHUNK_BYTES):
                found = aligned(parts, data, offsets, relation, figures)
                sizes = found.pop("n_pairs")
                found = {k: lists(v, sizes) if k in ("pairs", "times") else pa.array(v) for k, v in found.items()}
                numbers = pa.array(np.arange(row, row + rows.num_rows))
                row += rows.num_rows
                yield pa.RecordBatch.from_arrays([numbers, rows.column("doc_id"), *(found[c] for c in names[2:])], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tx.tidy(give), STORED)


def pair_counts(rows: DataFrame, codes_b: int) -> DataFrame:
    """(pair, n, best): how often each pair is linked in the corpus, and whether that is its B id's highest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def take() -> pa.RecordBatch:
            pairs, times = (np.concatenate(x) for x in zip(*held))
            own, back = np.unique(pairs, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(back, times, len(own)).astype(np.int64))], ["pair", "n"])

        for batch in batches:
            held.append(tuple(pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("pairs", "times")))
            size += len(held[-1][0])
            if size > COUNTED_PAIRS:
                yield take()
                held, size = [], 0
        if size:
            yield take()

    every = rows.select("pairs", "times").mapInArrow(tx.tidy(count), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    every = stored(every, "pair-counts").withColumn("b", F.col("pair") % codes_b)
    highest = every.groupBy("b").agg(F.max("n").alias("highest"))  # at most B's vocabulary
    return every.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def frequent(pairs: DataFrame, most: int) -> int:
    """The count from which at most `most` pairs are; pairs above MOST_COUNT count alike."""
    cut, held = MOST_COUNT + 1, 0
    for n, count in sorted(pairs.groupBy(F.least("n", F.lit(MOST_COUNT))).count().collect(), reverse=True):  # at most MOST_COUNT rows
        held += count
        if held > most:
            break
        cut = n
    return cut


def sums(rows: DataFrame, head: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """The stored rows with n_best and count_sum over the head's pairs, and the other pairs of each (null if it has none)."""
    shared = rows.sparkSession.sparkContext.broadcast(head)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, best = shared.value
        for batch in batches:
            lengths = pc.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False)
            pairs, times = (pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            spot = np.minimum(np.searchsorted(held, pairs), max(0, len(held) - 1))
            known = held[spot] == pairs if len(held) else np.zeros(len(pairs), bool)
            spot, of = spot[known], times[known].astype(np.int64)
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, row[known], of * best[spot])
            np.add.at(count_sum, row[known], of * n[spot])
            left = np.bincount(row[~known], minlength=batch.num_rows)
            own = {c: batch.column(c) for c in ("row", *SUMS) if c in batch.schema.names}
            own |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "pairs": lists(pairs[~known], left), "times": lists(times[~known], left)}
            yield pa.RecordBatch.from_arrays([own[c] for c in ("row", *SUMS, "pairs", "times")], ["row", *SUMS, "pairs", "times"])

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, pairs array<int>, times array<int>"
    return rows.mapInArrow(tx.tidy(give), schema)


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None, relation: str = "end", head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    paths = paths or tokenizer_paths()
    codes_b = len(PieceTokens(paths[1]).entries)
    rows = stored(alignments(docs, paths, relation), "alignments", compression="zstd")
    pairs = stored(pair_counts(rows, codes_b), "pairs")
    cut = frequent(pairs, head_pairs)
    held = pairs.filter(F.col("n") >= cut).toArrow() if cut <= MOST_COUNT else pairs.limit(0).toArrow()
    keys = held["pair"].to_numpy()
    order = np.argsort(keys)
    read = sums(rows, (keys[order], *(held[c].to_numpy()[order] for c in ("n", "best"))))
    rarer = pairs.filter(F.col("n") < cut)
    if rarer.isEmpty():
        return read.select(*SUMS)
    read = stored(read, "alignment-sums", compression="zstd")
    drop(rows)
    open_pairs = read.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    found = open_pairs.join(rarer, "pair")
    more = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    joined = read.drop("pairs", "times").join(more, "row", "left")
    of = {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
    return joined.withColumns(of).select(*SUMS)
