"""Sorted 64-bit keys with values, in one shared file per bucket of the key's top bits.

Buckets are written by one task each and memory-mapped by every task that looks keys up; only the
touched pages are read. The set of files that exist is passed along, so a missing file is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ledgerflow.llm.shared import kept, mapped_file, put_file


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def by_bucket(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[int], list[int]]:
    """Order by bucket, the buckets there, and where each begins (and the end)."""
    bucket = bucket_of(keys, bits)
    order = np.argsort(bucket, kind="stable")
    there, heads = np.unique(bucket[order], return_index=True)
    return order, there.tolist(), [*heads.tolist(), len(order)]


def sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sum of each stretch of values; `heads` are where they begin."""
    return np.add.reduceat(values, heads) if len(heads) else np.zeros(0, values.dtype)


def put_arrays(uri: str, *arrays: np.ndarray) -> None:
    """A file of arrays: their numbers of bytes first; give wide numbers before narrow ones, so that
    all stay aligned."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    put_file(uri, head.tobytes(), *(a.tobytes() for a in arrays))


@kept(8192)
def get_arrays(uri: str, *kinds: type) -> list[np.ndarray]:
    raw = np.asarray(mapped_file(uri))  # plain arrays, which are quicker to index
    n = int(raw[:8].view(np.int64)[0])
    sizes, at, out = raw[8 : 8 + 8 * n].view(np.int64).tolist(), 8 + 8 * n, []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(raw[at : at + size].view(kind))
        at += size
    return out


def stretches(sorted_keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The buckets of sorted keys, and their stretches."""
    edges = np.searchsorted(sorted_keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist()
    for b, (i, j) in enumerate(zip(edges, [*edges[1:], len(sorted_keys)], strict=True)):
        if j > i:
            yield b, slice(i, j)


def match(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys


def look_up(folder: str, files: frozenset[int], bits: int, keys: np.ndarray, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Value of each key (0 if it is not there), and whether it is, from files of keys and values."""
    order = np.argsort(keys)
    keys = keys[order]
    values, found = np.zeros(len(keys), kind), np.zeros(len(keys), bool)
    for b, part in stretches(keys, bits):
        if b in files:
            table, own = get_arrays(f"{folder}/{b:06d}", np.uint64, kind)
            at, known = match(table, keys[part])
            values[order[part]] = np.where(known, own[at], 0)
            found[order[part]] = known
    return values, found
