"""Words, lines and hashes of UTF-8 text, vectorised over the bytes of Arrow columns.

A block is a stretch of whole texts: ``data`` holds their bytes, ``offsets`` where
each begins and ends. Blocks are cut at text borders so that the temporary arrays stay
small; a text longer than ``BLOCK`` is a block of its own. Words are runs of bytes
other than space, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def release() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


kept: dict = {}  # what this worker keeps for later tasks that ask for it


def _trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; before each next one, what the work on the one before freed goes back to the system."""
    for batch in batches:
        yield batch
        del batch
        release()


def released(work: Callable, batches: Iterator[pa.RecordBatch], keeps: bool) -> Iterator[pa.RecordBatch]:
    """``work(batches)`` in a worker that lives on: freed memory goes back to the system batch by batch and
    at the end, and unless it ``keeps`` them, what tasks of another kind left in the worker goes first."""
    if not keeps and kept:
        kept.clear()
        release()
    yield from work(_trimmed(batches))
    release()


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, bytes, offsets) of stretches of about ``BLOCK`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never crosses a text border."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    borders = offsets[:-1]
    borders = borders[borders < len(inside)]
    start[borders] = inside[borders]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    inner = borders[borders > 0] - 1
    end[inner] = inside[inner]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each text's words begin (n + 1 numbers)."""
    starts, ends = runs(~_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the non-empty lines, and where each text's lines begin."""
    starts, ends = runs(data != 10, offsets)
    return starts, ends, np.searchsorted(starts, offsets)


_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each segment; segments are not empty."""
    out = np.empty(len(starts), np.uint64)
    lengths = ends - starts
    upto = np.cumsum(lengths)
    i = 0
    while i < len(starts):
        before = upto[i] - lengths[i]
        j = max(i + 1, int(np.searchsorted(upto, before + BLOCK, "right")))
        size = lengths[i:j]
        first = upto[i:j] - size - before
        place = np.arange(int(upto[j - 1] - before)) - np.repeat(first, size)
        value = _BYTES[data[place + np.repeat(starts[i:j], size)]]
        value *= _powers_to(int(size.max()))[place]
        out[i:j] = mixed(np.add.reduceat(value, first) ^ (size.astype(np.uint64) * _BASE))
        i = j
    return out


def texts_of(bounds: np.ndarray) -> np.ndarray:
    """The text number of every item, given where each text's items begin."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` items, and the item where each begins."""
    if len(hashes) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    text = texts_of(bounds)
    where = np.flatnonzero(text[: len(text) - width + 1] == text[width - 1 :])
    total = np.zeros(len(where), np.uint64)
    for k in range(width):
        total = total * _BASE + hashes[where + k]
    return mixed(total), where


def counts_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    upto = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return upto[offsets[1:]] - upto[offsets[:-1]]


def repeated(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which items equal another of the same text, and which equal an earlier one."""
    twice, later = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        key = mixed(hashes ^ (text.astype(np.uint64) + np.uint64(1)) * _BASE)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        later[order[1:]] = same
        twice[order[1:]] = same
        twice[order[:-1]] |= same
    return twice, later


class Block:
    """Words, lines and the exact base counts of the quality operators for one block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self.starts, self.ends, self.bounds = words(data, offsets)
        self.n_words = np.diff(self.bounds)
        self.text = texts_of(self.bounds)
        self.hashes = segment_hashes(data, self.starts, self.ends)
        self.whole = (data & 0xC0) != 0x80  # first bytes of code points
        space = _SPACE[data]
        self.word_chars = counts_between(self.whole & ~space, offsets)

    def count(self, characters: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(characters)] = True
        return counts_between(table[self.data], self.offsets)

    def per_text(self, flags: np.ndarray, text: np.ndarray) -> np.ndarray:
        return np.bincount(text[flags], minlength=self.n)

    def duplicate_lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them that equal an earlier one."""
        starts, ends, bounds = lines(self.data, self.offsets)
        filled = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        text = texts_of(bounds)[filled]
        hashes = segment_hashes(self.data, starts[filled], ends[filled])
        later = repeated(hashes, text)[1]
        return np.bincount(text, minlength=self.n), self.per_text(later, text)

    def repeated_words(self, width: int) -> np.ndarray:
        """Words inside windows of ``width`` words that are found twice or more."""
        hashes, where = window_hashes(self.hashes, self.bounds, width)
        hit = where[repeated(hashes, self.text[where])[0]]
        step = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + width, -1)
        return self.per_text(np.cumsum(step[:-1]) > 0, self.text)


def gram_slots(data: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Hash slot of the ``width`` bytes that begin at each byte."""
    n = max(len(data) - width + 1, 0)
    code = data[:n].astype(np.uint32)
    for k in range(1, width):
        code = code * np.uint32(0x01000193) + data[k : k + n]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - bits)


def gram_bounds(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end position of the byte windows that lie inside each text."""
    return offsets[:-1], np.maximum(offsets[1:] - width + 1, offsets[:-1])


def sums_between(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of the values from ``first`` up to ``end`` for each text; 0 where none."""
    out = np.zeros(len(first))
    some = np.flatnonzero(end > first)
    if len(some):
        edges = np.stack([first[some], end[some]], 1).ravel()
        last = edges[-1] >= len(values)
        out[some] = np.add.reduceat(values, edges[:-1] if last else edges)[::2]
    return out


def slot_counts(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and how often each occurs."""
    return np.unique(slots, return_counts=True)
