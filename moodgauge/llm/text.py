"""Numpy views of many texts at once: words, hashes of spans, and chunks of bounded size.

A chunk is a run of whole texts laid end to end as bytes, with offsets; no text is cut. Null texts are empty.
Hashes are 64 bits: a span is the sum of random byte values times powers of an odd number modulo 2**64, then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

# word separators of every contract: space and \x09 to \x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and where each text begins (one more offset at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[starts[0] : starts[-1]], starts - starts[0]


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES, most_rows: int = 1 << 16) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of a batch with about `size` bytes of text (one longer text stands alone), bytes and offsets."""
    data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    begin, rows = 0, batch.num_rows
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), begin + most_rows, rows)
        yield batch.slice(begin, end - begin), data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def spans(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of True; no run crosses an offset."""
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(len(solid) + 1, bool)
    border[offsets] = border[0] = border[-1] = True
    before, after = np.append(False, solid[:-1]), np.append(solid[1:], False)
    begin = np.flatnonzero(solid & (~before | border[:-1]))
    return begin, np.flatnonzero(solid & (~after | border[1:])) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and how many words lie before each text (one more at the end)."""
    begin, end = spans(~SPACE[data], offsets)
    return begin, end, np.searchsorted(begin, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each part between line feeds, empty parts left out, and how many lie before each text."""
    begin, end = spans(data != 10, offsets)
    return begin, end, np.searchsorted(begin, offsets)


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(kind)
    if held is None or len(held) < n:
        room = max(n, CHUNK_BYTES + 1)
        held = np.full(room, base, np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if room <= 4 * CHUNK_BYTES:
            _powers[kind] = held
    return held[:n]


def sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which `span_hash` takes the hash of any span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power("up", _BASE, len(data)), out=out[1:], dtype=np.uint64)
    return out


def span_hash(running: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the bytes of each span; equal bytes, equal hash, wherever they lie."""
    return mix((running[end] - running[begin]) * _power("down", _BASE_INVERSE, len(running))[begin])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive items, by the place of the first; windows over a text's border are the caller's to mask."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(n):
            factor = factor * np.uint64(0xD6E8FEB86659FD93) + np.uint64(2)
            out += hashes[k : k + len(out)] * (factor | np.uint64(1))
    return mix(out)


def whole_windows(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For items in runs of the given counts: places where a window of n lies in one run, and the run of each."""
    run = np.repeat(np.arange(len(counts)), counts)
    if len(run) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.flatnonzero(run[: len(run) - n + 1] == run[n - 1 :])
    return places, run[places]


def give_back() -> None:
    """Gives memory that a worker does not use back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work; when a task is over, its worker gives unused memory back, as the next task may be another operator's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run
