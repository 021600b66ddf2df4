"""How the sources of a language differ in their words.

In-mapper stripes. A task folds whole documents into a hash table: for each (language, term) one
stripe, which holds the number of documents with the term and the term's places by source. A full
table is sent on and begun anew. Stripes meet by key: they come sorted to the merging task, which
adds up neighbours as they pass and keeps one stripe at a time. A merged stripe gives all that the
divergences need: its term's share in each source and in the language, so pairs of sources are
summed from it directly and terms ranked.

Arithmetic is in whole numbers throughout. A pair's matrix takes a task 8 bytes for each pair of a
language's sources; the result has a row for each of them anyway.

Rows: NULL texts, languages and sources are empty strings; repeated rows count as often as they
occur; only these three columns are read; a language without kept terms has pairs of value 0; no
rows give no rows. Equal values are ordered by item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.hash_files import get_arrays, put_arrays, sums
from ledgerflow.llm.shared import shared_folder, ship, stored
from ledgerflow.llm.words import LOWER, buffers, slices, split

#: A term's document and place counts of a source that a task holds before it sends its table on.
HELD = 1_500_000
#: Shares are counted in units of 1 / SHARE.
SHARE = 1_000_000_000
#: Numbers in a block of shares that is worked on at a time.
BLOCK = 1 << 20

_GAP = np.ones(256, bool)
_GAP[97:123] = _GAP[128:] = False

STRIPES = "lang string, term string, df long, sources array<long>, counts array<long>"
PARTS = "lang string, a long, b long, term string, value long"


def _lists(values: np.ndarray, heads: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(heads, len(values)).astype(np.int32)), pa.array(values))


class _Table:
    """The hash stripes of a task."""

    def __init__(self) -> None:
        self.stripe: dict[tuple[str, bytes], int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def fold(self, batch: pa.RecordBatch) -> None:
        data, offsets = buffers(batch.column("text"))
        found = split(LOWER[data], offsets, gaps=_GAP)
        if not len(found.codes):
            return
        terms, lang = found.distinct.to_pylist(), batch.column("lang").dictionary_encode()
        source, lang_of = batch.column("source").to_numpy(), lang.indices.to_numpy()
        sources, source_of = np.unique(source, return_inverse=True)
        # Places of each term in each document, then of each term in each language and source.
        seen, places = np.unique(found.text_of() * len(terms) + found.codes, return_counts=True)
        doc, term = np.divmod(seen, len(terms))
        group = (lang_of[doc].astype(np.int64) * len(terms) + term) * len(sources) + source_of[doc]
        order = np.argsort(group, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
        key, at = np.divmod(group[order[heads]], len(sources))
        names, inverse = np.unique(key, return_inverse=True)
        langs, own = lang.dictionary.to_pylist(), self.stripe
        number = np.array([own.setdefault((langs[k // len(terms)], terms[k % len(terms)]), len(own)) for k in names.tolist()], np.int64)
        self.parts.append((number[inverse], sources[at], np.diff(np.append(heads, len(order))), sums(places[order], heads)))
        self.held += len(heads)
        if self.held > HELD:
            self.parts = [_added(self.parts)]
            self.held = len(self.parts[0][0])

    def sent(self) -> Iterator[pa.RecordBatch]:
        """The stripes as rows; the table is empty after it."""
        if not self.parts:
            return
        stripe, source, df, count = _added(self.parts)
        heads = np.flatnonzero(np.append(True, np.diff(stripe) != 0))  # stripes are numbered without gaps
        names = list(self.stripe)
        whole = pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in names], pa.string()), pa.array([t for _, t in names], pa.binary()).cast(pa.string()),
             pa.array(sums(df, heads)), _lists(source, heads), _lists(count, heads)],
            ["lang", "term", "df", "sources", "counts"],
        )
        self.__init__()
        yield from (whole.slice(i, 50_000) for i in range(0, whole.num_rows, 50_000))


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Entries in order of stripe and source, equal ones added up."""
    stripe, source, *numbers = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((source, stripe))
    stripe, source = stripe[order], source[order]
    heads = np.flatnonzero(np.append(True, (stripe[1:] != stripe[:-1]) | (source[1:] != source[:-1])))
    return stripe[heads], source[heads], *(sums(x[order], heads) for x in numbers)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _Table()
    for batch in slices(batches, "text"):
        table.fold(batch)
        if table.held > HELD // 2:
            yield from table.sent()
    yield from table.sent()


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Add up the stripes of equal keys, which come one after the other; the last one of a batch waits."""
    last: pa.RecordBatch | None = None

    def kept(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pa.array(rows.column("df").to_numpy() >= least))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([last, batch]) if last else batch
        lang, term = (rows.column(c).dictionary_encode().indices.to_numpy() for c in ("lang", "term"))
        new = np.append(True, (np.diff(lang) != 0) | (np.diff(term) != 0))
        heads, stripe = np.flatnonzero(new), np.cumsum(new) - 1
        source, count = rows.column("sources"), rows.column("counts")
        sizes = np.diff(source.offsets.to_numpy())
        own, key, total = _added([(np.repeat(stripe, sizes), source.flatten().to_numpy(), count.flatten().to_numpy())])
        first = np.searchsorted(own, np.arange(len(heads)))
        one = rows.take(pa.array(heads))
        out = pa.RecordBatch.from_arrays(
            [one.column("lang"), one.column("term"), pa.array(sums(rows.column("df").to_numpy(), heads)), _lists(key, first), _lists(total, first)],
            ["lang", "term", "df", "sources", "counts"],
        )
        last = out.slice(out.num_rows - 1)
        if out.num_rows > 1:
            yield kept(out.slice(0, out.num_rows - 1))
    if last:
        yield kept(last)


def stripes(docs: DataFrame, least: int) -> DataFrame:
    """lang, term, df, sources (their keys), counts: the terms in at least so many documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _merge(batches, least)

    sent = docs.mapInArrow(_fold, STRIPES)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(parts, "term", "lang").sortWithinPartitions("term", "lang").mapInArrow(run, STRIPES)


def _file(folder: str, lang: str) -> str:
    return f"{folder}/{xxhash.xxh3_64_hexdigest(lang)}"


def _totals(groups: DataFrame, kept: DataFrame, folder: str) -> None:
    """One file a language: its sources' keys in order with their places of kept terms, and the number
    of kept terms."""
    places = kept.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("key")).agg(F.sum("counts").alias("n"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    rows = groups.join(places, ["lang", "key"], "left").join(terms, "lang", "left").na.fill(0, ["n", "v"])
    whole = rows.groupBy("lang", "v").agg(F.sort_array(F.collect_list(F.struct("key", "n"))).alias("by")).select("lang", "v", "by.key", "by.n")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                put_arrays(_file(folder, r["lang"]), np.array(r["key"], np.int64), np.array(r["n"], np.int64), np.array([r["v"]], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("lang")], ["lang"])

    whole.mapInArrow(write, "lang string").write.format("noop").mode("overwrite").save()


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SHARE * (count + 2) / (total + 2 * terms)), by long division, so nothing overflows."""
    whole = total + 2 * terms
    quotient, rest = np.divmod(count + 2, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digit
    return quotient + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Language:
    """What a task has gathered of one language."""

    def __init__(self, keys: np.ndarray, totals: np.ndarray, terms: int, top: int) -> None:
        self.keys, self.totals, self.terms, self.top = keys, totals, terms, top
        self.pairs = np.zeros((len(keys), len(keys)), np.int64)
        self.first: list[list[tuple[int, bytes]]] = [[] for _ in keys]

    def add(self, terms: list[str], row: np.ndarray, key: np.ndarray, count: np.ndarray) -> None:
        """Terms with their entries (row of the term, source, places)."""
        most = max(1, BLOCK // len(self.keys))
        for low in range(0, len(terms), most):
            part = slice(*np.searchsorted(row, [low, low + most]))
            names = [t.encode() for t in terms[low : low + most]]
            counts = np.zeros((len(names), len(self.keys)), np.int64)
            counts[row[part] - low, np.searchsorted(self.keys, key[part])] = count[part]
            p = shares(counts, self.totals, self.terms)
            for a in range(len(self.keys) - 1):
                self.pairs[a, a + 1 :] += _apart(p[:, a : a + 1], p[:, a + 1 :]).sum(axis=0)
            q = shares(counts.sum(axis=1), self.totals.sum(), self.terms)
            for a, held in enumerate(self.first):
                at = np.flatnonzero((counts[:, a] > 0) & (p[:, a] > q))
                value = _apart(p[at, a], q[at])
                if len(at) > self.top:  # all that are no less than the last that can count
                    limit = np.partition(value, len(at) - self.top)[len(at) - self.top]
                    at, value = at[value >= limit], value[value >= limit]
                held.extend((-v, names[i]) for v, i in zip(value.tolist(), at.tolist(), strict=True))
                held.sort()
                del held[self.top :]

    def rows(self, lang: str) -> Iterator[tuple]:
        for a, b in zip(*np.nonzero(self.pairs), strict=True):
            yield lang, int(self.keys[a]), int(self.keys[b]), None, int(self.pairs[a, b])
        for key, held in zip(self.keys.tolist(), self.first, strict=True):
            yield from ((lang, key, None, term.decode(), -value) for value, term in held)


def _diverge(batches: Iterator[pa.RecordBatch], folder: str, top: int) -> Iterator[pa.RecordBatch]:
    found: dict[str, _Language] = {}
    for batch in batches:
        lang = batch.column("lang").dictionary_encode()
        for k, name in enumerate(lang.dictionary.to_pylist()):
            rows = batch.filter(pa.array(lang.indices.to_numpy() == k))
            if name not in found:
                keys, totals, terms = get_arrays(_file(folder, name), np.int64, np.int64, np.int64)
                found[name] = _Language(keys, totals, int(terms[0]), top)
            sizes = np.diff(rows.column("sources").offsets.to_numpy())
            entries = (rows.column(c).flatten().to_numpy() for c in ("sources", "counts"))
            found[name].add(rows.column("term").to_pylist(), np.repeat(np.arange(len(sizes)), sizes), *entries)
    names = PARTS.replace(",", "").split()[::2]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    for name, held in found.items():
        out = list(held.rows(name))
        for i in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 50_000], strict=True), kinds, strict=True)], names)


def _groups(docs: DataFrame) -> DataFrame:
    """lang, key, source: every source of every language."""
    same = F.when(F.min("source") == F.max("source"), F.min("source")).otherwise(F.raise_error(F.lit("two sources of one language have one hash")))
    return docs.groupBy("lang", F.col("source_key").alias("key")).agg(same.alias("source"))


def audit(docs: DataFrame, least: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    A share is p = 1 + floor(10**9 * (places + 2) / (places of all kept terms + 2 * kept terms)); two
    shares are floor((p - q)**2 / (p + q)) apart. Part `pair`: each other source of the language, by
    the sum over the language's terms of at least `least` documents. Part `term`: the `top` terms of
    which the source has more than its language."""
    source = F.coalesce(F.col(source_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.xxhash64(source).alias("source_key"), source.alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    ship(spark)
    groups = stored(_groups(rows), "groups")
    kept = stored(stripes(rows.select("lang", F.col("source_key").alias("source"), "text"), least), "stripes")
    folder = shared_folder(spark, "totals")
    _totals(groups, kept, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _diverge(batches, folder, top)

    found = stored(kept.select("lang", "term", "sources", "counts").mapInArrow(run, PARTS), "divergences")
    name = groups.select("lang", F.col("key").alias("a"), "source")
    apart = found.where("b is not null").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = apart.unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    other = groups.select("lang", F.col("key").alias("b"), F.col("source").alias("item"))
    pairs = name.join(other, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    terms = found.where("term is not null").join(name, ["lang", "a"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return pairs.unionByName(terms).withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
