"""Best-fit decreasing packing of token pieces into sequences of a fixed capacity.

A piece's place depends on its length and on how many pieces of that length come before it, so the
pieces are numbered within their length, and best-fit decreasing runs once over the *histogram* of
lengths: at most `capacity` rows, whatever the corpus. The pieces of one length that go into bins
of one remaining capacity are placed in one step; a segment tree over remaining capacities finds
the tightest open bins in logarithmic time. The steps are ranges (length, numbers -> bins, offset);
each piece looks its range up. The outcome is that of best-fit decreasing over the whole corpus,
with no groups that are packed apart.

Rows: a NULL or empty text is one piece that holds the end token alone; repeated rows are packed
once each; a NULL id stays NULL; only the id and text columns are read; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.shared import ship, stored
from ledgerflow.llm.tokens import ENCODED, token_ids
from ledgerflow.llm.words import slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, local long"


class OpenBins:
    """Open bins by remaining capacity: a segment tree of counts, and the bins as number ranges."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[deque] = [deque() for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        k = room + self.leaves
        while k:
            self.count[k] += n
            k >>= 1

    def put(self, room: int, first: int, n: int) -> None:
        if room > 0:
            self.bins[room].append((first, n))
            self._add(room, n)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to `most` bins, next to one another, of this remaining capacity."""
        first, n = self.bins[room].popleft()
        if n > most:
            self.bins[room].appendleft((first + most, n - most))
            n = most
        self._add(room, -n)
        return first, n

    def tightest(self, need: int) -> int:
        """The least remaining capacity of an open bin that is at least `need`; 0 if there is none."""
        k = need + self.leaves
        if self.count[k]:
            return need
        while k > 1:
            if k % 2 == 0 and self.count[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.count[2 * k] else 2 * k + 1
                return k - self.leaves
            k >>= 1
        return 0


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over the histogram of lengths. Rows: length, first number of the range,
    first bin, offset; piece k of a length is in bin `first bin + k - first number` of its range."""
    bins, used, rows = OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        k, left = 0, histogram[length]
        while left:
            # The tightest bin stays the tightest while it has room, so it takes as many as fit.
            room = bins.tightest(length)
            fit = min((room or capacity) // length, left)
            if room:
                first, n = bins.take(room, left // fit)
            else:
                room, first, n = capacity, used, left // fit
                used += n
            for j in range(fit):
                rows.append((length, k + j * n, first, capacity - room + j * length))
            bins.put(room - fit * length, first, n)
            k, left = k + fit * n, left - fit * n
    return np.array(rows, np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's token ids and the end id, cut into pieces of at most `capacity`; `part` and
    `local` number the pieces of each length within their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = token_ids(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text", ENCODED):
            found, places = encoder.encode(batch.column("text"))
            sizes = np.diff(places) + 1
            ends = np.cumsum(sizes)
            ids = np.full(int(ends[-1]), end_id, "<u4")
            mask = np.ones(len(ids), bool)
            mask[ends - 1] = False
            ids[mask] = found
            n = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = number * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            raw, at = memoryview(ids.tobytes()), 4 * ((ends - sizes)[doc] + start)
            cuts = [raw[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            kinds, heads, many = np.unique(length[order], return_index=True, return_counts=True)
            local = np.empty(len(length), np.int64)
            local[order] = np.arange(len(length)) - np.repeat(heads - seen[kinds], many)
            seen[kinds] += many
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(number, pa.int32()), pa.array(start), pa.array(length),
                 pa.array(list(map(zlib.crc32, cuts)), pa.int64()), pa.array(cuts if keep_ids else [None] * len(cuts), pa.binary()),
                 pa.array(np.full(len(doc), part), pa.int32()), pa.array(local)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "local"],
            )

    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece, and its `ids`
    (little-endian unsigned 32-bit) on request. Texts are encoded once; the pieces are kept in the
    shared folder."""
    spark = docs.sparkSession
    # Token ids hardly shrink under fast codecs.
    cut = stored(pieces(docs, tokenizer, capacity, end_id, keep_ids, id_col, text_col), "pieces", codec="zstd" if keep_ids else None)
    in_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(in_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "counts")
    # One row per length: at most `capacity` rows, however many the pieces.
    histogram = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = plan(histogram, capacity)
    keys = ranges[:, 0] << 48 | ranges[:, 1]
    order = np.argsort(keys)
    # Bounded by the capacity: each length splits at most one range of bins, and opens two.
    table = spark.sparkContext.broadcast((keys[order], ranges[order]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = table.value
        for batch in batches:
            number = batch.column("number").to_numpy()
            row = rows[np.searchsorted(at, batch.column("length").to_numpy() << 48 | number, "right") - 1]
            kept = batch.drop_columns(["number"])
            yield kept.append_column("sequence_id", pa.array(row[:, 2] + number - row[:, 1])).append_column("offset", pa.array(row[:, 3]))

    numbered = cut.join(base.drop("n"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []),
        (F.col("local") + F.col("before")).alias("number"),
    )
    ids = ", ids binary" if keep_ids else ""
    return numbered.mapInArrow(place, f"doc_id long, piece int, start long, length long, ids_crc32 long{ids}, sequence_id long, offset long")
