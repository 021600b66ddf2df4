"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes: each byte adds a fixed random number, and everything before moves
up one bit, so the hash depends on the last `WINDOW` bytes. A chunk ends where the hash is less
than at any of the `REACH` places before and after. That is decided by the bytes around it alone,
so an insertion changes the chunks around it and no others, and chunks have at least REACH + 1
bytes. Chunks are known by digest; a digest that two documents or more hold belongs to the one with
the least id, and is a repeat in the others.

A repeat is reported where chunks known from other documents follow one another over at least
`LEAST_WORDS` words. Inside such a stretch, `LEAST_WORDS` words or more of chunks that all belong to
other documents are parts of their own; shorter ones are chance (a phrase that an earlier document
has too) and stay with the document's own chunks around them. A chunk of the document's own is thus
never cut. Parts of others are divided where passages of so many words belong to different
documents. A passage loses up to a chunk and the hash's window at either end, so a
passage of 50 words, whose chunks would otherwise have nothing in common with other documents, has
about 40 words in whole chunks.

Rows: a NULL or empty text has no chunks; rows of one id are one document, and so are all rows
without an id; repeated rows get their spans each; only the id and text columns are read, and
`remove_repeats` carries the others along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.hash_files import by_bucket, look_up, put_arrays
from ledgerflow.llm.shared import bucket_count, shared_folder, ship
from ledgerflow.llm.words import SPACE, buffers, slices, spread

#: Bytes that the hash depends on, and places on either side that a chunk's end is less than.
WINDOW, REACH = 16, 12
#: Words that consecutive repeated chunks must hold.
LEAST_WORDS = 25

_GEAR = (spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_PAD = WINDOW + REACH
_NOBODY = np.iinfo(np.int64).max


@dataclass
class Chunks:
    """Chunks of a slice of texts, in order: their text, bytes [start, stop) and digest."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    digest: np.ndarray


def _gear_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rolling hash at each byte, texts apart; and where each text's bytes are in that array.
    Between texts lie zeros while hashes are added up and the greatest number afterwards, so that
    neither hashes nor minima look into another text."""
    size = np.diff(offsets)
    places = offsets[:-1] + _PAD * np.arange(1, len(size) + 1)
    out = np.zeros(int(offsets[-1]) + _PAD * (len(size) + 1), np.uint32)
    gear = _GEAR[data]
    for a, b, at in zip(offsets[:-1].tolist(), offsets[1:].tolist(), places.tolist(), strict=True):
        out[at : at + b - a] = gear[a:b]
    step = 1
    while step < WINDOW:  # sums over 1, 2, 4, ... bytes
        out[step:] += out[:-step] << np.uint32(step)
        step *= 2
    for a, b in zip((places + size).tolist(), [*places[1:].tolist(), len(out)], strict=True):
        out[a:b] = 0xFFFFFFFF
    out[:_PAD] = 0xFFFFFFFF
    return out, places


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of n values from each place on (the last n - 1 places are left out)."""
    have = 1
    while have < n:
        step = min(have, n - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> Chunks:
    hashes, places = _gear_hashes(data, offsets)
    least = _least(hashes, REACH)
    ends = np.zeros(len(hashes), bool)
    middle = hashes[REACH:-REACH]
    ends[REACH:-REACH] = (middle < least[: len(middle)]) & (middle < least[REACH + 1 : REACH + 1 + len(middle)])
    at = np.flatnonzero(ends)
    text = np.searchsorted(places, at, "right") - 1
    cut = at - places[text] + offsets[text] + 1
    full = np.flatnonzero(np.diff(offsets) > 0)
    stop = np.union1d(cut, offsets[full + 1])
    start = np.concatenate([np.zeros(1, np.int64), stop[:-1]]) if len(stop) else stop
    raw, h = data.tobytes(), xxhash.xxh3_64_intdigest
    digest = np.fromiter((h(raw[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)), np.uint64, len(stop))
    return Chunks(np.searchsorted(offsets, start, "right") - 1, start, stop, digest)


def _owners(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NOBODY).to_numpy()


@dataclass(frozen=True)
class Repeats:
    """Where the digests are that several documents hold: files of digest and the least id."""

    folder: str
    files: frozenset[int]
    bits: int


def find_repeats(docs: DataFrame, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> Repeats:
    """Count the chunks of all documents. A bucket's digests are sorted in one task's memory."""
    spark = docs.sparkSession
    ship(spark)
    buckets = buckets or bucket_count(spark)
    bits, folder = buckets.bit_length() - 1, shared_folder(spark, "chunks")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = chunks_of(*buffers(batch.column("text")))
            if not len(found.digest):
                continue
            owner = _owners(batch.column("doc_id"))[found.text]
            # Once per digest and document, as far as one slice shows.
            order = np.lexsort((owner, found.digest))
            digest, owner = found.digest[order], owner[order]
            new = np.concatenate([[True], (digest[1:] != digest[:-1]) | (owner[1:] != owner[:-1])])
            digest, owner = digest[new], owner[new]
            # Of a digest that many documents hold, the least and the greatest id tell all.
            first = np.concatenate([[True], digest[1:] != digest[:-1]])
            last = np.concatenate([digest[1:] != digest[:-1], [True]])
            digest, owner = digest[first | last], owner[first | last]
            order, there, heads = by_bucket(digest, bits)
            columns = [[x[order[i:j]].tobytes() for i, j in zip(heads, heads[1:], strict=False)] for x in (digest, owner)]
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["bucket", "digest", "owner"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def flush() -> pa.RecordBatch:
            digest = np.concatenate([np.frombuffer(h["digest"], np.uint64) for h in held])
            owner = np.concatenate([np.frombuffer(h["owner"], np.int64) for h in held])
            order = np.argsort(digest, kind="stable")
            digest, owner = digest[order], owner[order]
            heads = np.flatnonzero(np.concatenate([[True], digest[1:] != digest[:-1]]))
            least, most = np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads)
            shared = least < most
            if shared.any():
                put_arrays(f"{folder}/{bucket:06d}", digest[heads][shared], least[shared])
            return pa.RecordBatch.from_arrays([pa.array([bucket] * bool(shared.any()), pa.int32())], ["bucket"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != bucket:
                    yield flush()
                    held = []
                bucket = row["bucket"]
                held.append(row)
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sent = rows.mapInArrow(send, "bucket int, digest binary, owner binary")
    written = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(write, "bucket int")
    return Repeats(folder, frozenset(r["bucket"] for r in written.collect()), bits)  # one row a file


@dataclass
class Runs:
    """Stretches of repeated chunks: text, bytes [start, stop), words, the document that they belong
    to, and whether that is the text's own: some of the chunks are in no earlier document."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    words: np.ndarray
    owner: np.ndarray
    own: np.ndarray


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before; the first does."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _tails(heads: np.ndarray, n: int) -> np.ndarray:
    """The last place of each stretch."""
    return np.append(heads[1:], n)[: len(heads)] - 1


def _spread_out(values: np.ndarray, heads: np.ndarray, n: int) -> np.ndarray:
    """The value of each stretch at each of its places."""
    return np.repeat(values, _tails(heads, n) + 1 - heads)


def _settled(owner: np.ndarray, heads: np.ndarray, sure: np.ndarray | None = None) -> np.ndarray:
    """Owners with those that are not sure replaced by the last sure one of the stretch, or by its
    first sure one where none comes before. Sure by default: two chunks of one owner in a row."""
    n = len(owner)
    stretch = _spread_out(np.arange(len(heads)), heads, n)
    if sure is None:
        same = np.zeros(n + 1, bool)
        same[1:n] = (owner[1:] == owner[:-1]) & (stretch[1:] == stretch[:-1])
        sure = same[1:] | same[:-1]
    back = np.maximum.accumulate(np.where(sure, np.arange(n), -1)) if n else np.zeros(0, np.int64)
    ahead = np.minimum.accumulate(np.where(sure, np.arange(n), n)[::-1])[::-1] if n else back
    use = np.where((back >= 0) & (stretch[back] == stretch), back, ahead)
    some = use < n
    some[some] = stretch[use[some]] == stretch[some]
    return np.where(some, owner[np.where(some, use, 0)], owner) if n else owner


def _most(owner: np.ndarray, size: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The owner of the most bytes of each stretch; of several, the least."""
    kinds, code = np.unique(owner, return_inverse=True)
    stretch = _spread_out(np.arange(len(heads)), heads, len(owner))
    pairs, place = np.unique(stretch * max(1, len(kinds)) + code, return_inverse=True)
    total = np.bincount(place, size, len(pairs)).astype(np.int64)
    order = np.lexsort((pairs, -total, pairs // max(1, len(kinds))))
    best = order[_changes(pairs[order] // max(1, len(kinds)))] if len(order) else order
    return kinds[pairs[best] % max(1, len(kinds))] if len(best) else np.zeros(0, np.int64)


def _runs(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, repeats: Repeats, least_words: int) -> Runs:
    found = chunks_of(data, offsets)
    owner, known = look_up(repeats.folder, repeats.files, repeats.bits, found.digest, np.int64)
    at = np.flatnonzero(known)
    text, owner = found.text[at], owner[at]
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(begins)])

    def words(heads: np.ndarray) -> np.ndarray:
        return before[found.stop[at[_tails(heads, len(at))]]] - before[found.start[at[heads]]]

    # A stretch ends with the text and where a chunk is not known, and around enough chunks of others.
    apart = np.ones(len(at), bool)
    apart[1:] = (np.diff(at) > 1) | _changes(text)[1:]
    other = owner != ids[text]
    heads = np.flatnonzero(apart | _changes(other))
    theirs = _spread_out(other[heads] & (words(heads) >= least_words), heads, len(at))
    parts = np.flatnonzero(apart | _changes(theirs))
    own = ~_spread_out(np.logical_and.reduceat(other, parts) if len(parts) else np.zeros(0, bool), parts, len(at))

    # Stretches of others are divided where one long passage follows another document's.
    near = _settled(owner, parts)
    heads = np.flatnonzero(_changes(near) | np.isin(np.arange(len(at)), parts))
    solid = _spread_out(words(heads) >= least_words, heads, len(at)) & ~own
    near = _settled(near, parts, solid)
    heads = np.flatnonzero(np.isin(np.arange(len(at)), parts) | (_changes(near) & ~own))
    first = np.where(own[heads], ids[text[heads]], _most(near, found.stop[at] - found.start[at], heads))
    n = words(heads)
    long = n >= least_words
    start, stop = found.start[at[heads]], found.stop[at[_tails(heads, len(at))]]
    return Runs(text[heads][long], start[long], stop[long], n[long], first[long], own[heads][long])


SPANS = "doc_id long, start long, stop long, n_words long, first_doc_id long, is_first boolean"


def repeated_spans(docs: DataFrame, repeats: Repeats, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each repeated stretch of each document: code points [start, stop), words, the
    document it belongs to, and whether that is this document."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in SPANS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            r = _runs(data, offsets, _owners(batch.column("doc_id")), repeats, least_words)
            chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
            start, stop = chars[r.start] - chars[offsets[r.text]], chars[r.stop] - chars[offsets[r.text]]
            owner = pa.array(r.owner, mask=r.owner == _NOBODY)
            columns = [batch.column("doc_id").take(pa.array(r.text)), pa.array(start), pa.array(stop), pa.array(r.words), owner, pa.array(r.own)]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SPANS)


def remove_repeats(docs: DataFrame, repeats: Repeats, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the repeated stretches that belong to other documents cut out of the texts."""
    ship(docs.sparkSession)
    own = docs.columns
    i, t = own.index(id_col), own.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(own)))).withColumns({f"c{i}": F.col(f"`c{i}`").cast("long"), f"c{t}": F.col(f"`c{t}`").cast("string")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"c{t}"):
            data, offsets = buffers(batch.column(t))
            r = _runs(data, offsets, _owners(batch.column(i)), repeats, least_words)
            keep = np.ones(len(data) + 1, np.int8)
            for a, b, mine in zip(r.start.tolist(), r.stop.tolist(), r.own.tolist(), strict=True):
                if not mine:
                    # Whole characters: one that the cut begins or ends in stays.
                    while a < b and data[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                        b -= 1
                    keep[a:b] = 0
            left = keep[:-1].astype(bool)
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(left)])[offsets]
            text = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[left])])
            columns = list(batch.columns)
            columns[t] = text.cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return plain.mapInArrow(run, plain.schema).toDF(*own)
