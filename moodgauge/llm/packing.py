"""Hierarchical multi-length packing of tokenised documents.

Each task tokenises its own documents and packs them, so no token is shuffled. A document gives whole windows of the longest
tier first; its rest is routed to the shortest tier that holds it. Tiers are packed from long to short: a window takes a rest of
its tier, its gap takes the largest rests of shorter tiers that fit, and when none fits, a short rest is cut to close the gap. What
can't fill a window waits for the task's next documents; at the end of the task it is cut into windows of powers of two. So all
windows are full. Windows of a buffer are dealt, longest first, over step groups of equal token budgets.

Words are tokenised once per task: this tokenizer never joins across white space, nor a letter with a following sign, and it
lowers case, so a text's ids are those of its lowered words and signs in turn.

Defined cases: a null or empty text is the end id alone; rows that repeat are packed each; a null doc_id stays null; further
columns are ignored; an empty table gives no pieces. Ids of sequences and groups are unique over the result, not consecutive.
"""

from __future__ import annotations

import os
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.llm import text as tx

TIERS = (256, 512, 1024, 2048)
END_ID = 1
BUFFER_TOKENS = 1 << 19
GROUP_TOKENS = 32 * 2048
KNOWN_WORDS = 300_000

# bytes of ASCII letters; of words of letters up to U+024F; and signs that end a word of letters for the tokenizer.
# An apostrophe may begin a part of its own, and a bar belongs to the names of special tokens, so neither is a sign here.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
PLAIN = LETTER.copy()
PLAIN[0x80:0xC0] = PLAIN[0xC3:0xCA] = True
SIGN = np.zeros(256, bool)
SIGN[[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) not in "'|"]] = True
BAR = ord("|")
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, tier int, step_group long, ids binary"


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Ids of texts, with the ids of words seen so far kept by hash; at KNOWN_WORDS words the memory starts anew."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def of_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())), sizes

    def of_plain_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, encoded in rows: each word's last id is one that ends a word."""
        rows = [" ".join(texts[k : k + 64]) for k in range(0, len(texts), 64)]
        ids = np.fromiter((i for x in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False) for i in x.ids), np.uint32)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(texts) else self.of_words(texts)

    def learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> None:
        """hashes: sorted and not known yet."""
        raw = data.tobytes()
        texts = np.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist())], object)
        odd = ~PLAIN[data]
        odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the signs of times and division
        running = np.append(0, np.cumsum(odd))
        plain = running[end] == running[begin]
        sizes, starts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        pool = [self.pool]
        room = len(self.pool)
        for some, way in ((plain, self.of_plain_words), (~plain, self.of_words)):
            ids, own = way(texts[some].tolist())
            sizes[some] = own
            starts[some] = room + np.cumsum(own) - own
            pool.append(ids)
            room += len(ids)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.starts, self.sizes = np.insert(self.hashes, at, hashes), np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)
        self.pool = np.concatenate(pool)

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes in lower case, begin and end of words cut before a sign after a letter, and the first part of each text."""
        cut = np.flatnonzero(LETTER[data[:-1]] & SIGN[data[1:]]) + 1
        begin, end = tx.spans(~tx.SPACE[data], np.concatenate((offsets, cut)))
        lowered = tx.LOWER[data]
        running = np.append(0, np.cumsum(data == BAR))
        for k in np.flatnonzero((running[end] > running[begin]) & (end - begin > 12)):  # may hold a special token's name
            lowered[begin[k] : end[k]] = data[begin[k] : end[k]]
        return lowered, begin, end, np.searchsorted(begin, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, END_ID after each text, and where each text begins (one more at the end)."""
        data, begin, end, at = self.parts(data, offsets)
        hashes = tx.span_hash(tx.sums(data), begin, end)
        if len(self.hashes) > KNOWN_WORDS:
            self.forget()
        own, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, own)
        known = np.zeros(len(own), bool)
        known[place < len(self.hashes)] = self.hashes[place[place < len(self.hashes)]] == own[place < len(self.hashes)]
        if not known.all():
            new = first[~known]
            self.learn(data, begin[new], end[new], own[~known])
            place = np.searchsorted(self.hashes, own)
        sizes, starts = self.sizes[place][back], self.starts[place][back]
        upto = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=upto[1:])
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        ids = np.full(int(upto[-1]) + len(offsets) - 1, END_ID, np.uint32)
        within = np.arange(upto[-1])
        ids[within + np.repeat(text, sizes)] = self.pool[within + np.repeat(starts - upto[:-1], sizes)]
        return ids, upto[at] + np.arange(len(offsets))


class Packer:
    """Packs the documents of one task. A piece is (length, number, document, start); a document (id, ids)."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS):
        self.tiers, self.group_tokens, self.base = tiers, group_tokens, task << 33
        self.rests: list[tuple] = []  # ascending by length
        self.windows: list[tuple[int, list[tuple]]] = []
        self.held, self.pieces, self.sequences, self.groups = 0, 0, 0, 0

    def piece(self, document, start: int, length: int) -> tuple:
        self.pieces += 1
        return length, self.pieces, document, start

    def add(self, doc_id, ids: np.ndarray) -> None:
        document, top = (doc_id, ids), self.tiers[-1]
        whole = len(ids) // top * top
        for start in range(0, whole, top):
            self.windows.append((top, [self.piece(document, start, top)]))
        if whole < len(ids):
            self.rests.append(self.piece(document, whole, len(ids) - whole))
        self.held += len(ids)

    def cut(self, rest: tuple, room: int) -> tuple[tuple, tuple]:
        length, _, document, start = rest
        return self.piece(document, start, room), self.piece(document, start + room, length - room)

    def fill(self, window: list[tuple], gap: int, shorter: list[tuple], same: list[tuple]) -> int:
        """Closes the gap from shorter rests, then from rests of the same tier; gives what stays open."""
        while gap and (shorter or same):
            k = bisect_right(shorter, gap, key=lambda x: x[0])
            if k:
                rest = shorter.pop(k - 1)
            elif shorter:
                rest, more = self.cut(shorter.pop(0), gap)
                insort(shorter, more)
            else:
                rest = same.pop()
                if rest[0] > gap:
                    rest, more = self.cut(rest, gap)
                    insort(shorter, more)
            window.append(rest)
            gap -= rest[0]
        return gap

    def pack(self) -> None:
        """Packs all rests but those that can't fill a window."""
        left, waiting = sorted(self.rests), []
        for n, tier in reversed(list(enumerate(self.tiers))):
            least = self.tiers[n - 1] if n else 0
            k = bisect_right(left, least, key=lambda x: x[0])
            left, same = left[:k], left[k:][::-1]  # longest first; the shortest is cut last
            while same:
                first = same.pop(0)
                window = [first]
                gap = self.fill(window, tier - first[0], left, same)
                if gap:
                    waiting += window
                else:
                    self.windows.append((tier, window))
        self.rests = waiting

    def flush(self) -> Iterator[tuple]:
        """The rows of all windows so far: doc_id, piece, document's ids, sequence, offset, tier, group."""
        self.windows.sort(key=lambda w: -w[0])
        groups = max(1, round(sum(size for size, _ in self.windows) / self.group_tokens))
        for n, (size, window) in enumerate(self.windows):
            turn, k = divmod(n, groups)
            group = self.base + self.groups + (k if turn % 2 == 0 else groups - 1 - k)
            offset = 0
            for length, _, (doc_id, ids), start in window:
                yield doc_id, start, length, len(ids), self.base + self.sequences, offset, size, group, ids[start : start + length]
                offset += length
            self.sequences += 1
        self.groups += groups
        self.windows, self.held = [], 0

    def finish(self) -> None:
        """What is left, cut into windows of powers of two, the largest first."""
        self.pack()
        left = sum(x[0] for x in self.rests)
        for bit in reversed(range(left.bit_length())):
            if left >> bit & 1:
                window, room = [], 1 << bit
                while room:
                    rest = self.rests.pop(0)
                    if rest[0] > room:
                        rest, more = self.cut(rest, room)
                        self.rests.insert(0, more)
                    window.append(rest)
                    room -= rest[0]
                self.windows.append((1 << bit, window))


def record(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids"]
    columns = list(zip(*rows))
    doc_id, start, length, tokens, sequence, offset, tier, group, ids = columns
    order = [doc_id, start, length, tokens, sequence, offset, tier, group]
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64()]
    arrays = [pa.array(values, kind) for values, kind in zip(order, kinds)] + [pa.array([x.astype("<u4", copy=False).tobytes() for x in ids], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names)


def packed(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, tier, step_group and its ids (little-endian)."""
    path = tokenizer_path or word_tokenizer_path()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = WordTokens(path), Packer(TaskContext.get().partitionId())
        for batch in batches:
            for rows, data, offsets in tx.chunks(batch, "text"):
                ids, at = tokens.encode(data, offsets)
                for doc_id, begin, end in zip(rows.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    packer.add(doc_id, ids[begin:end])
                if packer.held >= BUFFER_TOKENS:
                    packer.pack()
                    yield record(list(packer.flush()))
                    packer.rests = [(n, k, (d, x.copy()) if x.base is not None else (d, x), s) for n, k, (d, x), s in packer.rests]
        packer.finish()
        if last := list(packer.flush()):
            yield record(last)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tx.tidy(pack), SCHEMA)


def pieces(docs: DataFrame, **options) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group."""
    return packed(docs, **options).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")
