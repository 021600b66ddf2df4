"""Splitting whole texts into words on Arrow buffers, for use inside tasks.

A word is a maximal run of bytes other than space and \\t..\\r. Texts are handled in slices of some
megabytes, so memory does not depend on a task's rows; one text is never cut. Each distinct word
of a slice is looked at once, whatever its number of places.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from ledgerflow.llm.shared import new_stage

# Arrow's own pool keeps what it once took; the system's gives large blocks back.
pa.set_memory_pool(pa.system_memory_pool())

#: Bytes of text that are worked on at a time (a longer text makes a longer slice).
SLICE = 6 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def give_back() -> None:
    """Return freed memory to the machine: workers outlive their tasks, and others need it."""
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text."""
    new_stage()
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
        give_back()


def gathered(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows, in batches that hold `most` bytes of text or more (the last one may hold fewer):
    what is done once a batch, and once for each distinct word of it, is done less often."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the place where each begins (one more at the end). A NULL
    text has no bytes."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """The words of a slice of texts. `codes[i]` is the place of word i in `distinct`; the words of
    text d are first[d]..first[d+1]; `start` and `size` are byte places in the slice's bytes."""

    codes: np.ndarray
    distinct: pa.LargeBinaryArray
    first: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of one value per word over each text; 0 for a text without words."""
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def text_of(self) -> np.ndarray:
        """The place of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each distinct word."""
        data, offsets = buffers(self.distinct)
        raw, places, h = data.tobytes(), offsets.tolist(), xxhash.xxh3_64_intdigest
        return np.fromiter((h(raw[a:b], seed) for a, b in zip(places, places[1:], strict=False)), np.uint64, len(self.distinct))


def split(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None, gaps: np.ndarray = SPACE) -> Words:
    """Words of each text; `cuts` marks bytes where a further word begins inside a run; `gaps` says of
    each byte value whether it parts words."""
    inside = ~gaps[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if cuts is not None:
        begins |= cuts & inside
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] |= inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:]
    start = np.flatnonzero(begins)
    size = np.flatnonzero(last) - start + 1
    column = pa.Array.from_buffers(
        pa.large_binary(),
        len(start),
        [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])), pa.py_buffer(data[inside])],
    ).dictionary_encode()
    return Words(column.indices.to_numpy(), column.dictionary, np.searchsorted(start, offsets), start, size)


def words_of(column: pa.Array, lower: bool) -> Words:
    """Words of a text column, A-Z lower-cased on request."""
    data, offsets = buffers(column)
    return split(LOWER[data] if lower else data, offsets)


def spread(h: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values, one to one (the finalising steps of a common public hash)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def runs(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, in a row."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.arange(total, dtype=np.int64) - np.repeat(before, sizes)


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] of each pair, in a row."""
    return values[np.repeat(starts, sizes) + runs(sizes)]
