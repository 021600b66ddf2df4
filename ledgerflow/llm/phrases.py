"""Phrases whose words belong together, counted over a prefix-free parse of the corpus.

Parse. A piece of a text (what lies between punctuation marks and line ends) is cut before every
word whose hash says so; the cuts depend on content only, so equal passages give equal chunks
wherever they stand. A chunk holds its own words and the first `ORDER - 1` words behind it in the
piece, its overlap with the next one. Equal chunks are counted once, in a dictionary with the
number of times that each occurs (its parse frequency); copies cost one row.

Count. An n-gram belongs to the chunk in which it begins, as one of the chunk's own words; it lies in
that chunk whole, because of the overlap. So the sum of parse frequencies over the distinct chunks is
its exact number of places. Levels go from one word up: an n-gram is counted only where both
(n-1)-grams in it are frequent, which loses none, since a part occurs as often as the whole at
least. Levels are counted by 64-bit hashes and kept as sorted files that tasks map; the phrases that
pass are counted again by their words, so a collision of hashes costs time but changes no count.

Rows: a NULL text is an empty one; a NULL lang is `und` (and so joins texts of that name); repeated
rows count as often as they occur; only the text and lang columns are read; no rows give no rows. A
phrase never crosses a punctuation mark. Equal scores are ordered by count, then by phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.hash_files import by_bucket, look_up, put_arrays, sums
from ledgerflow.llm.shared import bucket_count, shared_folder, ship, stored
from ledgerflow.llm.words import LOWER, buffers, gathered, ragged, runs, slices, split, spread

#: Words of the longest phrase.
ORDER = 4
#: One word in so many begins a new chunk.
TRIGGER = 16
#: Distinct n-grams that a task holds to add them up before it sends them.
HELD = 2_000_000
#: Bytes of chunks that are counted at a time: chunks are short, so a batch of rows holds few of them.
GATHERED = 4 << 20
#: Parts in which a language's best rows are sought before they meet.
SALTS = 64

_CUT, _GAP, _BLANK = (np.zeros(256, bool) for _ in range(3))
_CUT[[*b".,;:!?", *range(10, 14)]] = True
_GAP[[9, 32]] = True
_GAP |= _CUT
_BLANK[32] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)

CHUNKS = "lang string, own int, chunk string"
COUNTS = "bucket int, keys binary, counts binary"
PHRASES = "lang string, size int, phrase string, f long"


def _texts(places: np.ndarray, data: np.ndarray) -> pa.Array:
    """Strings from their bytes in a row and where each begins."""
    return pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])


def _hashes(distinct: pa.LargeBinaryArray) -> np.ndarray:
    """64-bit hash of each word, all at once: its bytes as digits, then mixed. Words that collide make
    a chunk end earlier or an n-gram be looked at in vain, and change no count."""
    data, places = buffers(distinct)
    if not len(places) - 1:
        return np.zeros(0, np.uint64)
    sizes = np.diff(places)
    powers = np.cumprod(np.full(int(sizes.max()), _ODD))
    return spread(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[runs(sizes)], places[:-1]))


def _chunks_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The chunks of a slice of texts, a space behind each word."""
    data, offsets = buffers(batch.column("text"))
    data = LOWER[data]
    found = split(data, offsets, gaps=_GAP)
    if not len(found.codes):
        return pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.int32()), pa.array([], pa.large_string())], ["lang", "own", "chunk"])
    text = found.text_of()
    marks = np.cumsum(_CUT[data], dtype=np.int32)[found.start]
    piece = np.ones(len(text), bool)
    piece[1:] = (text[1:] != text[:-1]) | (marks[1:] != marks[:-1])
    begin = piece | (_hashes(found.distinct) % np.uint64(TRIGGER) == 0)[found.codes]
    heads = np.flatnonzero(begin)
    tails = np.append(heads[1:], len(begin))
    ends = np.append(np.flatnonzero(piece)[1:], len(begin))
    stops = np.minimum(tails + (ORDER - 1), ends[np.cumsum(piece)[heads] - 1])
    words = np.repeat(heads, stops - heads) + runs(stops - heads)
    sizes = found.size[words] + 1
    body = ragged(np.append(data, np.uint8(32)), found.start[words], sizes)
    filled = np.cumsum(sizes)
    body[filled - 1] = 32
    places = np.append(0, filled[np.cumsum(stops - heads) - 1])
    return pa.RecordBatch.from_arrays(
        [batch.column("lang").take(pa.array(text[heads])), pa.array((tails - heads).astype(np.int32)), _texts(places, body)],
        ["lang", "own", "chunk"],
    )


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The dictionary of distinct chunks: lang, chunk (its words, a space behind each), own (words that
    are its own; those behind overlap with the next chunk), freq."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = _chunks_of(batch)
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1), out.column(2).cast(pa.string())], out.schema.names)

    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, CHUNKS).groupBy("lang", "own", "chunk").agg(F.count(F.lit(1)).alias("freq"))


@dataclass
class _Grams:
    """The words of a batch of chunks: `hash` of each with its language, `code` (equal for equal words),
    `left` (words from it to its chunk's end), `own`, and its chunk."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    code: np.ndarray
    left: np.ndarray
    own: np.ndarray
    chunk: np.ndarray
    freq: np.ndarray

    def longer(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each place, from those of n - 1 words (wrong where fewer are left)."""
        last = np.zeros(len(hashes), np.uint64)
        last[: max(0, len(last) - n + 1)] = self.hash[n - 1 :]
        return spread(hashes * _ODD + last)


def _grams_of(batch: pa.RecordBatch) -> _Grams:
    data, offsets = buffers(batch.column("chunk"))
    found = split(data, offsets, gaps=_BLANK)
    lang = batch.column("lang").dictionary_encode()
    mix = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in lang.dictionary.to_pylist()], np.uint64)[lang.indices.to_numpy()]
    chunk = found.text_of()
    at = np.arange(len(chunk)) - found.first[chunk]
    return _Grams(
        data, found.start, found.start + found.size, spread(mix[chunk] * _ODD + _hashes(found.distinct)[found.codes]),
        lang.indices.to_numpy()[chunk].astype(np.int64) * len(found.distinct) + found.codes, np.diff(found.first)[chunk] - at, at < batch.column("own").to_numpy()[chunk], chunk, batch.column("freq").to_numpy(),
    )


@dataclass(frozen=True)
class Frequent:
    """Hashes of the n-grams that occur often enough: one file per bucket that has some."""

    folder: str
    files: frozenset[int]
    bits: int

    def holds(self, hashes: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Whether each n-gram is frequent; False outside `where`."""
        out = np.zeros(len(hashes), bool)
        keys, place = np.unique(hashes[where], return_inverse=True)
        out[where] = look_up(self.folder, self.files, self.bits, keys, np.int64)[1][place]
        return out


def _add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[heads], sums(counts[order], heads)


def _sent(keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    order, there, heads = by_bucket(keys, bits)
    cuts = list(zip(heads, heads[1:], strict=False))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(there, pa.int32()),
            pa.array([keys[order[i:j]].tobytes() for i, j in cuts], pa.binary()),
            pa.array([counts[order[i:j]].tobytes() for i, j in cuts], pa.binary()),
        ],
        ["bucket", "keys", "counts"],
    )


def _frequent(chunks: DataFrame, n: int, below: Frequent | None, least: int, buckets: int) -> Frequent:
    """Count the n-grams of the dictionary whose parts are frequent, and keep the frequent ones."""
    bits = buckets.bit_length() - 1
    folder = shared_folder(chunks.sparkSession, f"frequent-{n}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in slices(gathered(batches, "chunk", GATHERED), "chunk"):
            g = _grams_of(batch)
            hashes, at = g.hash, g.own & (g.left >= n)
            for size in range(2, n):
                hashes = g.longer(hashes, size)
            if below:
                known = below.holds(hashes, g.left >= n - 1)
                at &= known & np.append(known[1:], False)
                hashes = g.longer(hashes, n)
            parts.append(_add([(hashes[at], g.freq[g.chunk[at]])]))
            held += len(parts[-1][0])
            if held > HELD:
                parts = [_add(parts)]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield _sent(*parts[0], bits)
                    parts, held = [], 0
        if held:
            yield _sent(*_add(parts), bits)

    def merged(bucket: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = _add(parts)
        kept = counts >= least
        if kept.any():
            put_arrays(f"{folder}/{bucket:06d}", keys[kept], counts[kept])
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([int(kept.sum())], pa.int64())], ["bucket", "kept"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, held = None, [], 0
        for batch in batches:
            for bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is not None and bucket != key:
                    yield merged(key, parts)
                    parts, held = [], 0
                key = bucket
                parts.append((np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)))
                held += len(parts[-1][0])
                if held > HELD:
                    parts = [_add(parts)]
                    held = 0
        if parts:
            yield merged(key, parts)

    dealt = chunks.mapInArrow(count, COUNTS).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    done = dealt.mapInArrow(add_up, "bucket int, kept long").where("kept > 0").collect()  # one row a file
    return Frequent(folder, frozenset(r["bucket"] for r in done), bits)


def _phrase_counts(chunks: DataFrame, levels: list[Frequent], least: int) -> DataFrame:
    """lang, size, phrase, f of every n-gram that occurs `least` times, counted by its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(gathered(batches, "chunk", GATHERED), "chunk"):
            g = _grams_of(batch)
            hashes, known = g.hash, np.zeros(0, bool)
            # Hashes say what is frequent; equal n-grams are found by the codes of their words.
            names, codes = g.code.copy(), int(g.code.max(initial=0)) + 1
            for n in range(1, ORDER + 1):
                if n > 1:
                    hashes = g.longer(hashes, n)
                whole = g.left >= n
                known = levels[n - 1].holds(hashes, whole) if n <= len(levels) else whole & known & np.append(known[1:], False)
                if n > 1:
                    some = np.flatnonzero(known)
                    names[some] = np.unique(names[some] * codes + g.code[some + n - 1], return_inverse=True)[1]
                at = np.flatnonzero(g.own & known)
                if not len(at):
                    continue
                _, one, place = np.unique(names[at], return_index=True, return_inverse=True)
                f = sums(g.freq[g.chunk[at]][by := np.argsort(place, kind="stable")], np.searchsorted(place[by], np.arange(len(one))))
                one = at[one]
                sizes = g.stop[one + n - 1] - g.start[one]
                phrases = _texts(np.append(0, np.cumsum(sizes)), ragged(g.data, g.start[one], sizes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").take(pa.array(g.chunk[one])), pa.array(np.full(len(one), n, np.int32)), phrases.cast(pa.string()), pa.array(f)],
                    ["lang", "size", "phrase", "f"],
                )

    counted = chunks.mapInArrow(run, PHRASES).groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= least)


def _part(words: str, first: str, size: str) -> str:
    return f"array_join(slice({words}, {first}, {size}), ' ')"


def _scored(counts: DataFrame) -> DataFrame:
    """The candidates with the parts and the score of their worst cut."""
    part = counts.select("lang", F.col("phrase").alias("part"), "f")
    cuts = (
        counts.where("size > 1")
        .select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .select("lang", "size", "phrase", "a", "k", F.expr(_part("w", "1", "k")).alias("first"), F.expr(_part("w", "k + 1", "size - k")).alias("rest"))
        .join(part.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first"])
        .join(part.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    )
    # 2,000,000 * a can pass 64 bits.
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "size", "phrase", "a").agg(worst).select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(counts: DataFrame) -> DataFrame:
    """lang, phrase, most: the count of the most frequent longer candidate around a phrase."""
    spans = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    longer = counts.where("size > 2").select("lang", "f", "size", F.split("phrase", " ").alias("w"))
    return longer.select("lang", "f", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each lang with their rank; first within parts of a lang."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    few = salted.withColumn("place", place).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return few.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)


def mine(docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of 2 to 4 words of each language.

    a: places of the phrase, `least` or more; l, r: of the two parts of its worst cut; n: words of the
    language; score: floor(2,000,000 * a / (l + r)). A phrase inside a longer one that has `cover`
    per cent of its places is left out."""
    spark = docs.sparkSession
    chunks = stored(parse(docs, text_col, lang_col), "chunks")
    levels: list[Frequent] = []
    for n in range(1, ORDER):
        levels.append(_frequent(chunks, n, levels[-1] if levels else None, least, bucket_count(spark)))
    counts = stored(_phrase_counts(chunks, levels, least), "phrases")
    words = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    around = F.col("most").isNotNull() & (F.col("most") * 100 >= F.col("a") * cover)
    alone = _scored(counts).join(_covered(counts), ["lang", "phrase"], "left").where(~around)
    return _best(alone, top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
