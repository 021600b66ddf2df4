"""Exact self-join of documents whose n-gram sets have a Jaccard similarity of a threshold or more.

The documents' n-gram incidence matrix is multiplied by its transpose block by block: a block is a
range of n-gram hashes, and holds for each n-gram the documents that have it. Bounds from the
sizes keep the product sparse. A document takes part with the n-grams of its prefix only (the
rarest n - ceil(t n) + 1 in one order for all documents): similar sets share one of those. And a
pair is formed at an n-gram only if what lies behind it in either set could still add up to the
overlap that the two sizes ask for: of two sets of one size, that is the first half of the prefix.
What is left is compared by a longer part of the sets with the same bound, and then set by set.

The order of the n-grams comes from a sketch of fixed size (document counts by hash slot): what
very many documents share comes last and hardly ever lies in a prefix. The order decides how much
is done, never the result.

Documents with equal sets are one class from the start. Links are needed for components only, so
each block's lists are first read as stars around one class each; the pairs that remain between
*different* components after that are counted and compared in a second round. So a group of near
copies costs its size, not its square, and no link between components is lost.

Rows: a NULL or empty text has no n-grams and is linked with nothing; fewer words than n make one
n-gram; repeated rows are one class; a NULL id is a row like others but never a component's name
unless all its ids are NULL; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.components import components
from ledgerflow.llm.hash_files import by_bucket, look_up, put_arrays
from ledgerflow.llm.shared import bucket_count, shared_folder, ship, stored
from ledgerflow.llm.words import Words, runs, slices, spread, words_of

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Slots of the sketch, as a power of two: one byte a slot in each task and where it is sent to all.
SKETCH_BITS = 22
#: Hundredths of the sets, rarest n-grams first, that pairs are compared by before whole sets are sent.
HEAD = 30
_PARTS = 64
#: Pairs of one list that are held at a time.
_PAIRS = 1 << 20


def shingles(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram that begins at each word, and where each text's begin (one more at the
    end). A text of fewer words has one n-gram, of all its words."""
    h, size = found.hashes()[found.codes], np.diff(found.first)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    at = np.repeat(found.first[:-1], count) + np.arange(first[-1]) - np.repeat(first[:-1], count)
    long = np.repeat(size >= n, count)
    out = np.zeros(len(at), np.uint64)
    start = at[long]
    mixed = h[start]
    for k in range(1, n):
        mixed = mixed * _ODD + h[start + k]
    out[long] = spread(mixed)
    short = np.flatnonzero((size < n) & (size > 0))
    for d in short.tolist():
        mixed = np.array([size[d]], np.uint64)
        for x in h[found.first[d] : found.first[d + 1]]:
            mixed = spread(mixed * _ODD + x)
        out[first[d]] = mixed[0]
    return out, first


def _sets(text: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-grams of each text."""
    grams, first = shingles(words_of(text, True), n)
    at = first.tolist()
    return [np.unique(grams[a:b]) for a, b in zip(at, at[1:], strict=False)]


def _digest(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes(), 3)


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _signatures(rows: DataFrame, n: int) -> DataFrame:
    """A row per document: its set's size and digest and its text's key; and rows of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "size", "digest", "text_key", "part", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in slices(batches, "text"):
            sets = _sets(batch.column("text"), n)
            slots, n_docs = np.unique(np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS), return_counts=True)
            seen[slots] += n_docs.astype(np.uint32)
            digest = np.array([_digest(own) for own in sets], np.uint64).view(np.int64)
            empty = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(own) for own in sets], pa.int64()), pa.array(digest),
                 batch.column("text_key"), empty.cast(pa.int32()), empty.cast(pa.binary())], names
            )
        seen = np.minimum(seen, 255).astype(np.uint8)
        part = [seen[k::_PARTS].tobytes() for k in range(_PARTS)] if seen.any() else []
        none = [None] * len(part)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([none, none, none, none, list(range(len(part))), part], kinds, strict=True)], names)

    return rows.mapInArrow(run, "doc_id long, size long, digest long, text_key long, part int, counts binary")


def _frequency_classes(sketch: DataFrame) -> np.ndarray:
    """The sketch of all documents as binary orders of magnitude: one byte a slot, of fixed number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.uint8).astype(np.int64)
        out = [(part, np.ceil(np.log2(np.maximum(x, 1))).astype(np.uint8).tobytes()) for part, x in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["part", "classes"])

    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in sketch.select("part", "counts").repartition(_PARTS, "part").mapInArrow(add, "part int, classes binary").collect():
        out[r["part"] :: _PARTS] = np.frombuffer(r["classes"], np.uint8)
    return out


def _rank(own: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The place of n-grams in the order of all: frequency class first, then hash."""
    return order[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58) | own >> np.uint64(6)


def _postings(rows: DataFrame, n: int, percent: int, classes, bits: int) -> DataFrame:
    """The prefix n-grams of each class, by bucket of the n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, sent = classes.value, set()
        for batch in slices(batches, "text"):
            gram, digest, size, times = [], [], [], []
            for own in _sets(batch.column("text"), n):
                if not len(own) or (d := _digest(own)) in sent:
                    continue
                if len(sent) < 1 << 20:  # only spares copies; without it they are dropped in the bucket
                    sent.add(d)
                count = len(own) + percent * len(own) // -100 + 1
                rank = _rank(own, order)
                head = np.argpartition(rank, count - 1)[:count] if count < len(own) else np.arange(count)
                gram.append(own[head[np.argsort(rank[head])]])
                digest.append(d)
                size.append(len(own))
                times.append(count)
            if not gram:
                continue
            grams, times = np.concatenate(gram), np.array(times)
            digests, sizes = np.repeat(np.array(digest, np.uint64), times), np.repeat(np.array(size, np.uint32), times)
            at, there, heads = by_bucket(grams, bits)
            values = (grams, digests, sizes, runs(times).astype(np.uint32))
            columns = [[x[at[i:j]].tobytes() for i, j in zip(heads, heads[1:], strict=False)] for x in values]
            names = ["bucket", "gram", "digest", "size", "place"]
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names)

    return rows.mapInArrow(run, "bucket int, gram binary, digest binary, size binary, place binary")


LISTS = "bucket int, many binary, digest binary, size binary, place binary"


def _lists(sent: DataFrame, buckets: int) -> DataFrame:
    """The n-grams that two classes or more share: numbers of classes, the classes, their sizes, and
    the n-gram's place in their order. A row holds some lists of a bucket; a list's classes go up in
    size, then digest."""

    def merge(bucket: int, held: list[dict]) -> Iterator[pa.RecordBatch]:
        gram, digest = (np.concatenate([np.frombuffer(h[c], np.uint64) for h in held]) for c in ("gram", "digest"))
        size, place = (np.concatenate([np.frombuffer(h[c], np.uint32) for h in held]) for c in ("size", "place"))
        order = np.argsort(gram, kind="stable")
        gram = gram[order]
        shared = np.zeros(len(gram), bool)
        shared[1:] = gram[1:] == gram[:-1]
        shared[:-1] |= shared[1:]
        order, gram = order[shared], gram[shared]
        digest, size, place = digest[order], size[order], place[order]
        order = np.lexsort((digest, size, gram))
        gram, digest, size, place = gram[order], digest[order], size[order], place[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1])
        gram, digest, size, place = gram[new], digest[new], size[new], place[new]
        heads = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
        many = np.diff(np.append(heads, len(gram)))
        keep = np.repeat(many > 1, many)
        many, digest, size, place = many[many > 1], digest[keep], size[keep], place[keep]
        ends = np.cumsum(many)
        block = (ends - 1) // _PAIRS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(many)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if j > i:
                a, b = int(ends[i] - many[i]), int(ends[j - 1])
                values = [many[i:j].astype(np.uint32), digest[a:b], size[a:b], place[a:b]]
                names = ["bucket", "many", "digest", "size", "place"]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != bucket:
                    yield from merge(bucket, held)
                    held = []
                bucket = row["bucket"]
                held.append(row)
        if held:
            yield from merge(bucket, held)

    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, LISTS)


PAIRS = "a long, b long"
_NO_PAIRS = np.zeros(0, np.int64)


@dataclass
class Held:
    """Lists of a bucket, one after another: numbers of classes, and of each the digest, the size and
    the n-gram's place."""

    many: np.ndarray
    digest: np.ndarray
    size: np.ndarray
    place: np.ndarray

    def possible(self, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Whether x and y, which share this n-gram, can be linked if they share none before it: what
        they have from here on must reach the overlap that their sizes ask for."""
        need = _needed(self.size[x], self.size[y], percent)
        return (self.size[x] - self.place[x] >= need) & (self.size[y] - self.place[y] >= need)

    def pairs(self, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        """Each pair of classes once."""
        a, b = np.minimum(self.digest[x], self.digest[y]), np.maximum(self.digest[x], self.digest[y])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return pa.RecordBatch.from_arrays([pa.array(a[new].view(np.int64)), pa.array(b[new].view(np.int64))], ["a", "b"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[Held]:
    for batch in batches:
        for row in batch.to_pylist():
            many, size, place = (np.frombuffer(row[c], np.uint32).astype(np.int64) for c in ("many", "size", "place"))
            yield Held(many, np.frombuffer(row["digest"], np.uint64), size, place)


def _shares(lists: DataFrame, percent: int) -> DataFrame:
    """(key, value) for each class of the lists: its digest, and the share of its prefix that other
    classes have too, in thousandths, with ties left to the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _unpacked(batches):
            own, first, n = np.unique(held.digest, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(held.size[first]), pa.array(n)], ["key", "size", "n"])

    counted = lists.mapInArrow(run, "key long, size long, n long").groupBy("key", "size").agg(F.sum("n").alias("n"))
    prefix = F.expr(f"size - ({percent} * size + 99) div 100 + 1")
    return counted.select("key", F.floor(1000 * F.col("n") / prefix).cast("long").alias("value"))


def _stars(lists: DataFrame, percent: int, folder: str, files: frozenset[int], bits: int) -> DataFrame:
    """Each class of a list with one of them: the one that shares most of its prefix with others. Of
    a text and its near copies that is the text itself, whose n-grams are nowhere its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _unpacked(batches):
            share, _ = look_up(folder, files, bits, spread(held.digest))
            of = np.repeat(np.arange(len(held.many)), held.many)
            order = np.lexsort((held.digest, -share.astype(np.int64), of))
            centre = np.repeat(order[np.cumsum(held.many) - held.many], held.many)
            other = np.arange(len(centre))
            pick = (other != centre) & held.possible(centre, other, percent)
            yield held.pairs(centre[pick], other[pick])

    return lists.mapInArrow(run, PAIRS).distinct()


def _between(lists: DataFrame, percent: int, folder: str, files: frozenset[int], bits: int) -> DataFrame:
    """The pairs of each list that lie in different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _unpacked(batches):
            label, known = look_up(folder, files, bits, spread(held.digest))
            label = np.where(known, label, held.digest)
            heads = np.cumsum(held.many) - held.many
            mixed = np.minimum.reduceat(label, heads) != np.maximum.reduceat(label, heads)
            x_all, y_all, total = [_NO_PAIRS], [_NO_PAIRS], 0
            for k in np.flatnonzero(mixed).tolist():
                i, j = int(heads[k]), int(heads[k] + held.many[k])
                # Sizes go up, so the partners that may fit a class follow it directly.
                last = i + np.searchsorted(held.size[i:j], 100 * held.size[i:j] // percent, "right")
                for x in range(i, j):
                    y = np.arange(x + 1, last[x - i])
                    y = y[(label[y] != label[x]) & held.possible(np.full(len(y), x), y, percent)]
                    if len(y):
                        x_all.append(np.full(len(y), x))
                        y_all.append(y)
                        total += len(y)
                    if total > _PAIRS:
                        yield held.pairs(np.concatenate(x_all), np.concatenate(y_all))
                        x_all, y_all, total = [_NO_PAIRS], [_NO_PAIRS], 0
            yield held.pairs(np.concatenate(x_all), np.concatenate(y_all))

    return lists.mapInArrow(run, PAIRS).distinct()


def _write_files(values: DataFrame, buckets: int, what: str) -> tuple[str, frozenset[int], int]:
    """Hash files of (key, value): the key is spread, so small numbers fall into all buckets."""
    bits = buckets.bit_length() - 1
    folder = shared_folder(values.sparkSession, what)

    def spread_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = spread(batch.column("key").to_numpy().view(np.uint64))
            order, there, heads = by_bucket(key, bits)
            value = batch.column("value").to_numpy()
            columns = [[x[order[i:j]].tobytes() for i, j in zip(heads, heads[1:], strict=False)] for x in (key, value)]
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["bucket", "key", "value"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def flush() -> pa.RecordBatch:
            key, value = (np.concatenate([np.frombuffer(h[c], np.uint64) for h in held]) for c in ("key", "value"))
            order = np.argsort(key)
            put_arrays(f"{folder}/{bucket:06d}", key[order], value[order])
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32())], ["bucket"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != bucket:
                    yield flush()
                    held = []
                bucket = row["bucket"]
                held.append(row)
        if held:
            yield flush()

    sent = values.select("key", "value").mapInArrow(spread_keys, "bucket int, key binary, value binary")
    written = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(write, "bucket int")
    return folder, frozenset(r["bucket"] for r in written.collect()), bits  # one row a file


def _compare(rows: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int, buckets: int, order, share: int) -> DataFrame:
    """The pairs whose sets are similar enough; with a `share` under 100, those that may be as far as
    the first hundredths of both sets tell."""
    needed = pairs.select(F.col("a").alias("digest")).union(pairs.select(F.col("b").alias("digest"))).distinct()
    wanted = classes.join(needed, "digest").select(F.col("text_key").alias("key"), F.col("digest").alias("value"))
    folder, files, bits = _write_files(wanted, buckets, "wanted-texts")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for batch in slices(batches, "text"):
            _, known = look_up(folder, files, bits, spread(batch.column("text_key").to_numpy().view(np.uint64)))
            if not known.any():
                continue
            out = []
            for own in _sets(batch.column("text").filter(pa.array(known)), n):
                if len(own) and (d := _digest(own)) not in sent:
                    sent.add(d)
                    head = own
                    if share < 100:
                        head = own[np.argsort(_rank(own, order.value))[: -(-share * len(own) // 100)]]
                    out.append((d, len(own), head.tobytes()))
            digest = np.array([d for d, _, _ in out], np.uint64).view(np.int64)
            columns = [pa.array(digest), pa.array([k for _, k, _ in out], pa.int64()), pa.array([s for _, _, s in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "size", "grams"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy()
            same = np.zeros(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(batch.column("grams_a"), batch.column("grams_b"), strict=True)):
                both = np.sort(np.concatenate([np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)]))
                same[k] = (both[1:] == both[:-1]).sum()
            # Behind the shorter of the two heads (in the order of all) lies the rest of its set.
            behind = np.maximum(size_a, size_b) - -(-share * np.maximum(size_a, size_b) // 100)
            yield batch.select(["a", "b"]).filter(pa.array(same + behind >= _needed(size_a, size_b, percent)))

    sets = stored(rows.mapInArrow(fetch, "digest long, size long, grams binary").dropDuplicates(["digest"]), "sets")
    one, two = (sets.select(F.col("digest").alias(x), F.col("size").alias(f"size_{x}"), F.col("grams").alias(f"grams_{x}")) for x in "ab")
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "size_a", "size_b", "grams_a", "grams_b")
    return stored(both.mapInArrow(compare, "a long, b long"), "links")


def join_similar(
    docs: DataFrame, percent: int = 85, n: int = 4, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, label of each row: the size of its set of n-grams,
    the least id of its component, the 64-bit hash of its text, and a number that the rows of a
    component share (NULL without n-grams). `percent`: the least Jaccard similarity in
    hundredths. `buckets` (a power of two, see `bucket_count`): blocks of the product."""
    spark = docs.sparkSession
    ship(spark)
    buckets = buckets or bucket_count(spark)
    bits = buckets.bit_length() - 1
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    found = stored(_signatures(rows, n), "signatures")
    of_docs = found.where("part is null").select("doc_id", "size", "digest", "text_key")
    classes = of_docs.where("size > 0").groupBy("digest").agg(F.min("text_key").alias("text_key"))
    order = spark.sparkContext.broadcast(_frequency_classes(found.where("part is not null")))  # 2**SKETCH_BITS bytes
    texts = rows.select("text", "text_key")
    lists = stored(_lists(_postings(texts, n, percent, order, bits), buckets), "lists")

    shares = _write_files(_shares(lists, percent), buckets, "shares")
    first = stored(_stars(lists, percent, *shares), "pairs")

    def compared(pairs: DataFrame) -> DataFrame:
        likely = _compare(texts, classes, pairs, n, percent, buckets, order, HEAD)
        return _compare(texts, classes, likely, n, percent, buckets, order, 100)

    links = compared(first)
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    labels = stored(components(edges), "labels")
    files = _write_files(labels.select(F.col("node").alias("key"), F.col("label").alias("value")), buckets, "labels")
    rest = stored(_between(lists, percent, *files).join(first, ["a", "b"], "left_anti"), "pairs")
    if rest.limit(1).count():
        more = compared(rest)
        edges = edges.union(more.select(F.col("a").alias("u"), F.col("b").alias("v")))
        labels = stored(components(edges), "labels")

    named = of_docs.where("size > 0").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    named = stored(named.select("doc_id", "size", "text_key", F.coalesce("label", "digest").alias("label")), "named")
    names = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(names, "label").select("doc_id", F.col("size").alias("n_shingles"), "component_id", "text_key", "label")
    empty = of_docs.where("size = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_key", F.lit(None).cast("long").alias("label"))
    return linked.union(empty)
