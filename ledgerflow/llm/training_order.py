"""Token sequences in training order, in fixed-stride binary shards.

Each task joins the token ids of its texts, an end id after each, to one stream and cuts it into
sequences of equal length; its last one may be shorter. Sequences are kept once in the shared
folder with their task and their number in it, so a task's count gives every sequence a number
without gaps. A keyed Feistel permutation, walked until it falls below the number of sequences,
turns the number into a slot: a shuffle of any size that needs no table and can be turned back.
Slots are cut into ranges; one task writes the shard of a range, each record at slot times stride.
A shard appears under its name only when it is whole, and one that is there is not written again,
so a broken run is taken up where it ended, and a reader starts at any slot with one seek.

Rows: a NULL or empty text is its end id alone; repeated rows are written once each; a NULL id
appears as NULL in `doc_ids`; only the id and text columns are read; no rows write no shards.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import drop_files, file_size, put_file, read_range, shared_folder, ship
from ledgerflow.llm.tokens import ENCODED, token_ids, tokenizer as open_tokenizer
from ledgerflow.llm.words import runs, slices, spread

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROUNDS = 6
SEQUENCES = "part int, local long, length int, ids_crc32 long, ids binary, doc_ids array<long>, starts array<int>"


class Feistel:
    """A permutation of 0..n-1 from a key: rounds on the halves of the number's bits, repeated while
    the outcome is n or more (a cycle of the wider permutation that begins below n comes back there)."""

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        self.half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = spread(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * _ODD + np.array([key], np.int64).view(np.uint64))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (spread(left * _ODD + k) & self.mask), left
            else:
                left, right = right, left ^ (spread(right * _ODD + k) & self.mask)
        return left << self.half | right

    def _walk(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(numbers.astype(np.uint64), back)
        while (far := np.flatnonzero(out >= np.uint64(self.n))).size:
            out[far] = self._once(out[far], back)
        return out.astype(np.int64)

    def slot(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def number(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


@dataclass(frozen=True)
class Shards:
    """What a reader needs: the folder, sequences in all and in a shard, ids in a sequence, and bytes
    of an id. Short sequences are filled up with id 0."""

    folder: str
    sequences: int
    per_shard: int
    length: int
    width: int

    @property
    def stride(self) -> int:
        return self.length * self.width

    def file(self, shard: int) -> str:
        return f"{self.folder}/shard-{shard:09d}.bin"

    def rows(self, shard: int) -> int:
        return min(self.per_shard, self.sequences - shard * self.per_shard)

    def read(self, slot: int, n: int = 1) -> np.ndarray:
        """The ids of slots slot..slot+n-1, a row each; one seek for each shard."""
        parts = []
        end = min(slot + n, self.sequences)
        while slot < end:
            shard, at = divmod(slot, self.per_shard)
            take = min(end - slot, self.rows(shard) - at)
            parts.append(read_range(self.file(shard), at * self.stride, take * self.stride))
            slot += take
        return np.frombuffer(b"".join(parts), f"<u{self.width}").reshape(-1, self.length)


def sequences(docs: DataFrame, tokenizer: str, length: int, end_id: int, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SEQUENCES: `starts` are the places where the documents of `doc_ids` begin, negative for
    one that began in an earlier sequence."""
    names = [x.split()[0] for x in SEQUENCES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, local = token_ids(tokenizer), TaskContext.get().partitionId(), 0
        rest, rest_ids, rest_starts = np.zeros(0, f"<u{width}"), pa.array([], pa.int64()), []

        def out(stream: np.ndarray, ids: pa.Array, starts: np.ndarray, count: int) -> pa.RecordBatch:
            """The first `count` sequences of a stream; documents begin at `starts`."""
            raw, size = memoryview(stream.tobytes()), length * width
            edges = np.arange(count) * length
            ends = np.minimum(edges + length, len(stream))
            # The document at a sequence's begin is the last that starts there or before.
            first = np.searchsorted(starts, edges, "right") - 1
            last = np.searchsorted(starts, ends, "left")
            many = last - first
            here = np.repeat(first, many) + runs(many)
            places = pa.array(np.append(0, np.cumsum(many)).astype(np.int32))
            docs_of = pa.ListArray.from_arrays(places, ids.take(pa.array(here)))
            starts_of = pa.ListArray.from_arrays(places, pa.array((starts[here] - np.repeat(edges, many)).astype(np.int32)))
            cuts = [raw[k * size : (k + 1) * size] for k in range(count)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, part), pa.int32()), pa.array(np.arange(local, local + count)), pa.array(ends - edges, pa.int32()),
                 pa.array(list(map(zlib.crc32, cuts)), pa.int64()), pa.array(cuts, pa.binary()), docs_of, starts_of], names
            )

        for batch in slices(batches, "text", ENCODED):
            found, places = encoder.encode(batch.column("text"))
            sizes = np.diff(places) + 1
            ends = np.cumsum(sizes)
            stream = np.full(int(ends[-1]), end_id, f"<u{width}")
            mask = np.ones(len(stream), bool)
            mask[ends - 1] = False
            stream[mask] = found
            stream = np.concatenate([rest, stream])
            ids = pa.concat_arrays([rest_ids, batch.column("doc_id")])
            starts = np.concatenate([np.array(rest_starts, np.int64), len(rest) + ends - sizes])
            count = len(stream) // length
            if count:
                yield out(stream, ids, starts, count)
            local += count
            done = count * length
            rest = stream[done:]
            keep = max(0, int(np.searchsorted(starts, done, "right")) - 1) if len(rest) else len(starts)
            rest_ids, rest_starts = ids.slice(keep), (starts[keep:] - done).tolist()
        if len(rest):
            yield out(rest, rest_ids, np.array(rest_starts, np.int64), 1)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SEQUENCES)


def materialise(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, key: int = 0, path: str | None = None,
    per_shard: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[Shards, DataFrame]:
    """Write the shards below `path` (default: the shared folder). Gives what reads them, and a row
    for each sequence: slot, shard, position, length, doc_ids, starts, ids_crc32 (of its ids, without the fill).
    With a `path`, shards of the same order are taken up, and those of any other go first."""
    spark = docs.sparkSession
    ship(spark)
    folder = path or shared_folder(spark, "training-order")
    width = 2 if open_tokenizer(tokenizer).get_vocab_size() <= 1 << 16 else 4
    cut = sequences(docs, tokenizer, length, end_id, width, id_col, text_col)
    # Token ids hardly shrink under fast codecs; this one pays for its time here.
    where = shared_folder(spark, "sequences")
    cut.write.option("compression", "zstd").parquet(where)
    cut = spark.read.schema(cut.schema).parquet(where)
    # What lies before each task's sequences: 16 bytes a task, so small enough for the driver and all tasks.
    counts = sorted((r["part"], r["n"]) for r in cut.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    parts, many = np.array(counts, np.int64).reshape(-1, 2).T
    known = spark.sparkContext.broadcast((parts, np.cumsum(many) - many))
    whole = cut.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(part, local, length, ids_crc32))").alias("mark")).first()
    total, mark = whole["n"], whole["mark"]  # the mark tells one set of numbered sequences from another
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_shard = per_shard or max(256, -(-total // (8 * tasks)))
    shards = Shards(folder, total, per_shard, length, width)
    order = Feistel(total, key)

    def slots(batch: pa.RecordBatch) -> np.ndarray:
        tasks_of, before = known.value
        at = np.searchsorted(tasks_of, batch.column("part").to_numpy())
        return order.slot(before[at] + batch.column("local").to_numpy())

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            slot = slots(batch)
            by = np.argsort(slot)
            raw, size, crc = batch.column("ids").to_pylist(), batch.column("length").to_numpy(), batch.column("ids_crc32").to_numpy()
            shard = slot[by] // per_shard
            heads = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(by) else []
            tails = np.append(heads[1:], len(by)) if len(by) else []
            rows = []
            for i, j in zip(heads, tails, strict=True):
                pick = by[i:j]
                body = b"".join([raw[k].ljust(shards.stride, b"\0") for k in pick.tolist()])
                rows.append((int(shard[i]) // ahead, int(shard[i]), slot[pick].tobytes(), size[pick].tobytes(), crc[pick].tobytes(), pack.compress(body)))
            if rows:
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["range", "shard", "slots", "sizes", "crcs", "body"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def flush() -> pa.RecordBatch:
            n = shards.rows(shard)
            if file_size(shards.file(shard)) != n * shards.stride:
                body, came = np.zeros((n, shards.stride), np.uint8), 0
                for slots, sizes, crcs, packed in held:
                    rows = np.frombuffer(slots, np.int64) - shard * per_shard
                    part = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(len(rows), -1)
                    own = zip(part, np.frombuffer(sizes, np.int32).tolist(), np.frombuffer(crcs, np.int64).tolist(), strict=True)
                    if any(zlib.crc32(ids[: size * width]) != crc for ids, size, crc in own):
                        raise RuntimeError(f"shard {shard}: a sequence has changed on its way")
                    body[rows] = part
                    came += len(rows)
                if came != n:
                    raise RuntimeError(f"shard {shard}: {came} of {n} sequences came")
                put_file(shards.file(shard), body.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64())], ["shard"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["shard"] != shard:
                    yield flush()
                    held = []
                shard = row["shard"]
                held.append((row["slots"], row["sizes"], row["crcs"], row["body"]))
        if held:
            yield flush()

    # What is there from another order, or from no known one, goes before this order is named.
    facts = json.dumps({k: v for k, v in asdict(shards).items() if k != "folder"} | {"key": key, "fingerprint": mark}).encode()
    manifest = f"{folder}/manifest.json"
    if file_size(manifest) != len(facts) or read_range(manifest, 0, len(facts)) != facts:
        drop_files(folder)
        put_file(manifest, facts)
    count = -(-total // per_shard)
    ahead = max(1, -(-count // tasks))
    sent = cut.select("part", "local", "length", "ids_crc32", "ids")
    sent = sent.mapInArrow(to_shards, "range int, shard long, slots binary, sizes binary, crcs binary, body binary")
    ranges = sent.repartitionById(max(1, -(-count // ahead)), "range").sortWithinPartitions("shard")
    written = ranges.mapInArrow(write, "shard long").count()
    if written != count:
        raise RuntimeError(f"{written} of {count} shards were written")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.drop_columns(["part", "local"]).append_column("slot", pa.array(slots(batch)))

    rows = cut.select("part", "local", "length", "doc_ids", "starts", "ids_crc32")
    placed = rows.mapInArrow(place, "length int, doc_ids array<long>, starts array<int>, ids_crc32 long, slot long")
    index = placed.withColumn("shard", F.expr(f"slot div {per_shard}")).withColumn("position", F.expr(f"slot % {per_shard}"))
    return shards, index.select("slot", "shard", "position", "length", "doc_ids", "starts", "ids_crc32")


def with_checksums(index: DataFrame, shards: Shards) -> DataFrame:
    """`index` with the CRC-32 of each sequence's ids (without the fill) as it is read back from the shards,
    to check a stored order; `materialise` has checked them as it wrote."""
    ship(index.sparkSession)
    index = index.drop("ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = []
            for slot, length in zip(batch.column("slot").to_pylist(), batch.column("length").to_pylist(), strict=True):
                shard, at = divmod(slot, shards.per_shard)
                crc.append(zlib.crc32(read_range(shards.file(shard), at * shards.stride, length * shards.width)))
            yield batch.append_column("ids_crc32", pa.array(crc, pa.int64()))

    # In slot order, so that each task reads its shards from front to back.
    ordered = index.repartition(F.col("shard")).sortWithinPartitions("slot")
    return ordered.mapInArrow(run, index.schema.add("ids_crc32", "long"))
