"""Quality rules: lines that too many documents of a host share are removed, and documents that
are left with too little are rejected.

A line's key is a hash of its words (A-Z lower-cased, white space ignored) and its host. Tasks
send each key with the digest of the document's text to the key's bucket, which counts distinct
digests: exact copies are one document. A host's documents are counted likewise, but spread over the
buckets by their digests, and the counts added up. Keys above the absolute limit meet the number of distinct
documents of their host; those above the share too are written to sorted hash files, which the
second pass over the texts maps. The document with the smallest digest keeps the line, so that no
content is lost altogether: of many near copies one stays whole.

A document fails the base rules if it has fewer than `LEAST_WORDS` words or more than half of its
words lie in 3-word windows that occur twice or more in it; else it is rejected if lines were
removed and fewer than `LEAST_WORDS` words or less than `LEAST_SHARE` of them are left.

Rows: a NULL or empty text has no words and fails; a NULL host is a host of its own; repeated rows
are one document when lines are counted and get a verdict each; a NULL id stays NULL; columns other
than the ones named are carried along by `keep_good`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.hash_files import by_bucket, look_up, put_arrays, sums
from ledgerflow.llm.shared import bucket_count, shared_folder, ship, stored
from ledgerflow.llm.words import LOWER, Words, buffers, runs, slices, split, spread

#: A document needs so many words, before and after lines are removed.
LEAST_WORDS = 50
#: A document is depleted if less than this share of its words is left.
LEAST_SHARE = 0.4
#: A line is removed if more documents of its host than this hold it ...
MOST_DOCS = 20
#: ... and more than this share of the host's documents, or ...
MOST_SHARE = 0.01
#: ... more than this, however many documents the host has: a large host does not shield its footers.
MANY_DOCS = 10_000
#: Lines of fewer words are left alone: they meet by chance.
LINE_WORDS = 3

#: Bytes of text that are judged at a time: counts are held for every byte and word of a slice.
JUDGED = 2 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NEWLINE = 10


@dataclass
class Lines:
    """The lines of a slice of texts that have a word: text, first word, number of words, key (of
    the line alone) and place in the bytes (without the newline)."""

    text: np.ndarray
    first: np.ndarray
    words: np.ndarray
    key: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def _line_edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines begin and end, those without a word too."""
    ends = np.flatnonzero(data == _NEWLINE)
    start = np.union1d(offsets[:-1][np.diff(offsets) > 0], ends + 1)
    start = start[start < len(data)]
    stop = np.append(start[1:], len(data))
    return start, stop - (data[stop - 1] == _NEWLINE)


def lines_of(found: Words, data: np.ndarray, offsets: np.ndarray) -> Lines:
    start, stop = _line_edges(data, offsets)
    first = np.searchsorted(found.start, start)
    words = np.diff(np.append(first, len(found.start)))
    some = words > 0
    start, stop, first, words = start[some], stop[some], first[some], words[some]
    place = runs(words).astype(np.uint64)
    key = sums(spread(_low_hashes(found)[found.codes] + place * _ODD), first)
    return Lines(np.searchsorted(offsets, start, "right") - 1, first, words, spread(key), start, stop)


def _low_hashes(found: Words) -> np.ndarray:
    """Hash of each distinct word, A-Z lower-cased."""
    data, offsets = buffers(found.distinct)
    raw, at, h = LOWER[data].tobytes(), offsets.tolist(), xxhash.xxh3_64_intdigest
    return np.fromiter((h(raw[a:b]) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(found.distinct))


def _hosts(column: pa.Array) -> np.ndarray:
    """64-bit hash of each host; NULL has one of its own."""
    coded = column.dictionary_encode()
    own = [xxhash.xxh3_64_intdigest(x.encode(), 1) for x in coded.dictionary.to_pylist()] + [7]
    return np.array(own, np.uint64)[coded.indices.fill_null(len(own) - 1).to_numpy(zero_copy_only=False)]


def _digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw, at, h = data.tobytes(), offsets.tolist(), xxhash.xxh3_64_intdigest
    return np.fromiter((h(raw[a:b]) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(at) - 1)


def _with_host(key: np.ndarray, host: np.ndarray) -> np.ndarray:
    return spread(key * _ODD + host)


def base_counts(found: Words, data: np.ndarray, offsets: np.ndarray, lines: Lines) -> dict[str, np.ndarray]:
    """Counts of each text that need no other text."""
    texts = len(offsets) - 1
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([np.zeros(1, np.int64), np.cumsum(_SYMBOL[data])])
    in_words = chars[found.start + found.size] - chars[found.start]
    # Equal lines: by their bytes, not by their keys.
    column = pa.Array.from_buffers(pa.large_binary(), 2 * len(lines.start), [None, pa.py_buffer(_ends(lines, len(data))), pa.py_buffer(data)])
    code = column.take(pa.array(np.arange(1, 2 * len(lines.start), 2))).dictionary_encode().indices.to_numpy()
    distinct = np.unique(lines.text << 32 | code)
    dup_lines = np.bincount(lines.text, minlength=texts) - np.bincount(distinct >> 32, minlength=texts)
    # Windows of three words: equal ones are next to one another once sorted.
    n, text = len(found.codes), found.text_of()
    repeated = np.zeros(n, bool)
    if n > 2:
        c = found.codes.astype(np.uint64)
        whole = text[2:] == text[:-2]
        window = spread(spread(spread(c[:-2] * _ODD + c[1:-1]) * _ODD + c[2:]) * _ODD + text[2:].astype(np.uint64))
        window = window[whole]
        ordered = np.sort(window)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        at = np.flatnonzero(whole)
        if len(twice):
            place = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
            at = at[twice[place] == window]
            for k in range(3):
                repeated[at + k] = True
    return {
        "n_words": np.diff(found.first),
        "word_chars": found.per_text(in_words),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": dup_lines,
        "n_repeat_words": found.per_text(repeated.astype(np.int64)),
    }


def _ends(lines: Lines, size: int) -> np.ndarray:
    """Places that cut the bytes into gap, line, gap, line, ..."""
    return np.concatenate([[0], np.column_stack([lines.start, lines.stop]).ravel()]).astype(np.int64)


@dataclass(frozen=True)
class Frequent:
    """Where the lines above the limits are: files of keys and of the digest that keeps the line."""

    folder: str
    files: frozenset[int]
    bits: int


def _dealt(trio: np.ndarray) -> np.ndarray:
    """What the bucket of each (key, host, digest) is taken from: a line's key; of a host, which any
    share of the documents may have, the digest as well, so that its documents spread."""
    key, host, digest = trio.T
    return np.where(key == _with_host(host, host), spread(key * _ODD + digest), key)


SENT = "bucket int, key binary, host binary, digest binary"


def _by_key(rows: Iterator[pa.RecordBatch], columns: list[str], merge) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: `merge` gets each bucket's arrays."""
    bucket, held = None, []
    for batch in rows:
        for row in batch.to_pylist():
            if held and row["bucket"] != bucket:
                yield from merge(bucket, [np.concatenate([np.frombuffer(h[c], np.uint64) for h in held]) for c in columns])
                held = []
            bucket = row["bucket"]
            held.append(row)
    if held:
        yield from merge(bucket, [np.concatenate([np.frombuffer(h[c], np.uint64) for h in held]) for c in columns])


def frequent_lines(
    docs: DataFrame, most_docs: int = MOST_DOCS, most_share: float = MOST_SHARE, line_words: int = LINE_WORDS,
    buckets: int | None = None, text_col: str = "text", host_col: str = "source", many_docs: int = MANY_DOCS,
) -> Frequent:
    """Lines that more than `most_docs` distinct documents and more than `most_share` of the distinct
    documents of one host hold, or more than `many_docs` whatever the host's size."""
    ship(docs.sparkSession)
    buckets = buckets or bucket_count(docs.sparkSession)
    bits = buckets.bit_length() - 1
    folder = shared_folder(docs.sparkSession, "lines")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            found = split(data, offsets)
            lines, host, digest = lines_of(found, data, offsets), _hosts(batch.column("host")), _digests(data, offsets)
            long = lines.words >= line_words
            text = lines.text[long]
            trio = np.column_stack([_with_host(lines.key[long], host[text]), host[text], digest[text]])
            # The host itself is counted like a line, under a key of its own.
            trio = np.concatenate([trio, np.column_stack([_with_host(host, host), host, digest])])
            _, one = np.unique(spread(trio[:, 0] * _ODD + trio[:, 2]), return_index=True)
            trio = trio[one]
            order, there, heads = by_bucket(_dealt(trio), bits)
            rows = [(b, *(trio[order[i:j], k].tobytes() for k in range(3))) for b, i, j in zip(there, heads, heads[1:], strict=False)]
            if rows:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 3], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "key", "host", "digest"])

    def count(bucket: int, arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, host, digest = arrays
        order = np.lexsort((digest, key))
        key, host, digest = key[order], host[order], digest[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])])
        key, host, digest = key[new], host[new], digest[new]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.diff(np.append(heads, len(key)))
        whole = key[heads] == _with_host(host[heads], host[heads])
        kept = (n > most_docs) | whole
        at = heads[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)) for x in (key[at], host[at], digest[at])] + [pa.array(n[kept]), pa.array(whole[kept])],
            ["key", "host", "digest", "n", "whole"],
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None

        def flush() -> pa.RecordBatch:
            key, digest = (np.concatenate(x).view(np.uint64) for x in zip(*held, strict=True))
            order = np.argsort(key)
            put_arrays(f"{folder}/{bucket:06d}", key[order], digest[order])
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32())], ["bucket"])

        for batch in batches:
            b, key, digest = (batch.column(c).to_numpy() for c in ("bucket", "key", "digest"))
            edges = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), len(b)]
            for i, j in zip(edges, edges[1:], strict=False):
                if j > i:
                    if held and b[i] != bucket:
                        yield flush()
                        held = []
                    bucket = int(b[i])
                    held.append((key[i:j], digest[i:j]))
        if held:
            yield flush()

    rows = docs.select(F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"))
    sent = rows.mapInArrow(send, SENT).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    names = ["key", "host", "digest"]
    counted = stored(sent.mapInArrow(lambda batches: _by_key(batches, names, count), "key long, host long, digest long, n long, whole boolean"), "line-counts")
    # A document is counted in one bucket, so a host's counts add up.
    hosts = counted.where("whole").groupBy("host").agg(F.sum("n").alias("docs"))
    above = counted.where("not whole").join(hosts, "host").where(F.col("n") > F.least(most_share * F.col("docs"), F.lit(float(many_docs))))
    above = above.select(F.shiftrightunsigned("key", 64 - bits).cast("int").alias("bucket"), "key", "digest")
    written = above.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(write, "bucket int")
    return Frequent(folder, frozenset(r["bucket"] for r in written.collect()), bits)  # one row a file


@dataclass
class Verdicts:
    counts: dict[str, np.ndarray]
    removed: np.ndarray
    left: np.ndarray
    failed: np.ndarray
    kept: np.ndarray
    texts: list[bytes] | None


def _judge(text: pa.Array, host: pa.Array, frequent: Frequent, line_words: int, clean: bool) -> Verdicts:
    data, offsets = buffers(text)
    found = split(data, offsets)
    lines = lines_of(found, data, offsets)
    counts = base_counts(found, data, offsets, lines)
    owner, known = look_up(frequent.folder, frequent.files, frequent.bits, _with_host(lines.key, _hosts(host)[lines.text]))
    gone = known & (lines.words >= line_words) & (owner != _digests(data, offsets)[lines.text])
    texts = len(offsets) - 1
    removed = np.bincount(lines.text[gone], minlength=texts)
    left = counts["n_words"] - np.bincount(lines.text[gone], lines.words[gone], minlength=texts).astype(np.int64)
    n = counts["n_words"]
    failed = (n < LEAST_WORDS) | (100 * counts["n_repeat_words"] > 50 * n)
    depleted = (removed > 0) & ((left < LEAST_WORDS) | (left < LEAST_SHARE * n))
    out = None
    if clean:
        raw, at = data.tobytes(), offsets.tolist()
        cuts: dict[int, list[int]] = {}
        for k in np.flatnonzero(gone).tolist():
            cuts.setdefault(int(lines.text[k]), []).append(k)
        out = []
        for d, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            parts, begin = [], a
            for k in cuts.get(d, ()):
                parts.append(raw[begin : lines.start[k]])
                begin = min(int(lines.stop[k]) + 1, b)
            out.append(b"".join([*parts, raw[begin:b]]))
    return Verdicts(counts, removed, left, failed, ~failed & ~depleted, out)


ASSESSED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_removed_lines long, words_left long, base_failed boolean, kept boolean")  # fmt: skip


def assess(
    docs: DataFrame, frequent: Frequent, line_words: int = LINE_WORDS, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """The counts and the verdict of each row."""
    names = [x.split()[0] for x in ASSESSED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", JUDGED):
            v = _judge(batch.column("text"), batch.column("host"), frequent, line_words, False)
            columns = [*v.counts.values(), v.removed, v.left, v.failed, v.kept]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names)

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"))
    return rows.mapInArrow(run, ASSESSED)


def keep_good(docs: DataFrame, frequent: Frequent, line_words: int = LINE_WORDS, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows that are kept, their texts without the removed lines; all columns of `docs`."""
    ship(docs.sparkSession)
    own = docs.columns
    t, h = own.index(text_col), own.index(host_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(own))))
    plain = plain.withColumns({f"c{t}": F.col(f"c{t}").cast("string"), f"c{h}": F.col(f"c{h}").cast("string")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"c{t}", JUDGED):
            v = _judge(batch.column(t), batch.column(h), frequent, line_words, True)
            columns = list(batch.columns)
            columns[t] = pa.array(v.texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(v.kept))

    return plain.mapInArrow(run, plain.schema).toDF(*own)
