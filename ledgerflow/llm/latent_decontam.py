"""Benchmark decontamination by latent semantic retrieval, with checks by common subsequence.

1. Weights: idf of every benchmark word from the document counts of the whole corpus. Vectors use
   its square, which leaves a passage's rare words to decide.
2. Space: a randomised SVD of the TF-IDF matrix of the benchmark's passages, in tasks over its
   passages and words: Y = A G for a seeded random G that is made from the words' hashes, a
   round of Y = A (A' Q) to sharpen it, orthogonalised through small Gram matrices, and the
   eigenvectors of B B' for B = Q' A. The benchmark spans the space, not the corpus: the corpus's
   own main directions are its frequent words, and leave out the rare ones that tell passages apart.
3. Search: every window of `WINDOW` words of every text, `STEP` apart, is folded into the space, and
   compared with all passages in blocks. A candidate has a cosine of `COSINE` or more and holds
   `CONTAINED` or more of the passage's length in the passage's direction (a window with hardly any
   benchmark words has a direction, but no length). A passage of up to WINDOW - STEP words lies
   whole in some window.
4. Checks: the longest common subsequence of the words of passage and window, weighted by idf, as
   a share of the passage; and the same for the passage's answer. A verbatim or nearly verbatim
   passage passes by the first alone, a paraphrase needs both.

Words are compared lower-cased and without punctuation. Rows: NULL and empty texts, on either side,
match nothing; passages longer than a window are cut; repeated rows get their results each; a NULL
id stays NULL; only the id, text and answer columns are read; `remove_leaks` carries the others
along, whatever their names. An empty benchmark or corpus gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.hash_files import get_arrays, put_arrays, sums
from ledgerflow.llm.shared import kept, shared_folder, ship, stored
from ledgerflow.llm.words import Words, buffers, slices, split

#: Words of a window, and from one window's begin to the next's.
WINDOW, STEP = 96, 32
#: Words of a passage, at most; longer items are cut, half a passage apart.
PASSAGE = WINDOW - STEP
#: Directions of the latent space, and further ones while it is computed.
RANK, SPARE = 128, 16
#: Least cosine of a candidate in the latent space, and least part of the passage's length.
COSINE, CONTAINED = 0.3, 0.3
#: Least weighted share in common: alone, and together with a share of the answer.
VERBATIM, PARAPHRASE, ANSWER = 0.65, 0.5, 0.5
#: Passages that are compared with the windows at a time.
_BLOCK = 1024

_LETTER = np.zeros(256, bool)  # what words are made of; bytes beyond ASCII belong to letters
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOW = np.full(256, 32, np.uint8)
_LOW[_LETTER] = np.flatnonzero(_LETTER)
_LOW[65:91] += 32


def _words(text: pa.Array) -> Words:
    """Words of texts, lower-cased, punctuation taken for space."""
    data, offsets = buffers(text)
    return split(_LOW[data], offsets)


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode())


@dataclass(frozen=True)
class Space:
    """Files of the fitted space: words (sorted hashes, idf, directions) and passages."""

    words: str
    passages: str
    rank: int


def _gaussians(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A row of n normal numbers for each word, from its hash alone."""
    return np.array([np.random.default_rng([seed, int(h)]).standard_normal(n) for h in hashes]).reshape(len(hashes), n)


def _passages(benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None) -> DataFrame:
    """The items' passages: words' hashes in order, and those of the answer. Without an answer
    column the answer is the item's last sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            last = [re.split(r"[.!?\n]+", (t or "").strip(" .!?\n\t\r"))[-1] for t in texts]
            answers = [a if a is not None else b for a, b in zip(batch.column("answer").to_pylist(), last, strict=True)]
            own, answer = _words(batch.column("text")), _words(pa.array(answers, pa.string()))
            own_hash, answer_hash = own.hashes(), answer.hashes()
            for d, item in enumerate(batch.column("item").to_pylist()):
                words = own_hash[own.codes[own.first[d] : own.first[d + 1]]]
                told = answer_hash[answer.codes[answer.first[d] : answer.first[d + 1]]]
                starts = [0] if len(words) <= PASSAGE else [*range(0, len(words) - PASSAGE, PASSAGE // 2), len(words) - PASSAGE]
                for k, at in enumerate(starts if len(words) else []):
                    part = words[at : at + PASSAGE]
                    rows.append((item, k, part.tobytes(), told[np.isin(told, part)].tobytes()))
            if rows:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "part", "words", "answer"])

    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"), answer.alias("answer"))
    return rows.mapInArrow(run, "item_id long, part int, words binary, answer binary")


def _document_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(place of a benchmark word, number of documents that hold it); place -1: documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known,) = get_arrays(vocabulary, np.uint64)
        total, texts = np.zeros(len(known), np.int64), 0
        for batch in slices(batches, "text"):
            found = _words(batch.column("text"))
            texts += batch.num_rows
            if not len(known) or not len(found.distinct):
                continue
            h = found.hashes()
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            place = np.where(known[at] == h, at, -1)[found.codes]
            text = found.text_of()[place >= 0]
            pairs = np.unique(text << 32 | place[place >= 0])
            total += np.bincount(pairs & 0xFFFFFFFF, minlength=len(known))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *used.tolist()], pa.int64()), pa.array([texts, *total[used].tolist()], pa.int64())], ["place", "n"])

    return docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))


def _matrix_sum(df: DataFrame, make, side: int) -> np.ndarray:
    """Sum over tasks of a small square matrix that `make` makes from a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side))
        for batch in batches:
            total += make(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    return sum((np.frombuffer(r["m"]).reshape(side, side) for r in df.mapInArrow(run, "m binary").collect()), np.zeros((side, side)))


def _rows_of(column: pa.Array, side: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(-1, side)


def _root(gram: np.ndarray) -> np.ndarray:
    """R with (Y R)'(Y R) = 1 on the directions that Y has, 0 on the others."""
    values, vectors = np.linalg.eigh(gram)
    sound = values > max(values.max(initial=0.0), 0.0) * 1e-10
    scale = np.where(sound, 1 / np.sqrt(np.where(sound, values, 1.0)), 0.0)
    return vectors * scale


def _products(entries: DataFrame, key: str, other: str, vectors: DataFrame, side: int) -> DataFrame:
    """Rows (key, v): sums over `other` of the matrix entry times the vector of `other`."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = _rows_of(batch.column("v"), side) * batch.column("weight").to_numpy()[:, None]
            for k, row in zip(batch.column(key).to_pylist(), rows, strict=True):
                total[k] = total[k] + row if k in total else row
            if len(total) > 4096:
                yield out(total)
                total = {}
        if total:
            yield out(total)

    def out(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary()), pa.array([1.0] * len(total))], [key, "v", "weight"])

    schema = f"{key} long, v binary, weight double"
    partial = entries.join(vectors.select(other, "v"), other).select(key, "weight", "v").mapInArrow(add, schema)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per key: a batch boundary may have left a key in two."""
        held, total = None, None
        for batch in add(batches):
            for k, row in zip(batch.column(key).to_pylist(), _rows_of(batch.column("v"), side), strict=True):
                if held is not None and k != held:
                    yield one(held, total)
                    total = None
                held, total = k, row if total is None else total + row
        if held is not None:
            yield one(held, total)

    def one(k: int, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([v.tobytes()], pa.binary())], [key, "v"])

    # Partial sums of one key are few: at most one for each task and 4096 keys.
    return partial.repartition(key).sortWithinPartitions(key).mapInArrow(finished, f"{key} long, v binary")


def _turned(vectors: DataFrame, key: str, side: int, by: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows_of(batch.column("v"), side) @ by
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([r.tobytes() for r in rows], pa.binary())], [key, "v"])

    return vectors.mapInArrow(run, f"{key} long, v binary")


def randomised_svd(entries: DataFrame, rank: int = RANK, spare: int = SPARE, rounds: int = 1, seed: int = 0) -> tuple[DataFrame, np.ndarray]:
    """Right singular vectors of a sparse matrix given as rows (row, col, weight), as rows (col, v) of
    float64 bytes, and the singular values. Only matrices of `rank + spare` squared reach the driver."""
    ship(entries.sparkSession)
    side = rank + spare

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _gaussians(batch.column("col").to_numpy(), side, seed)
            yield pa.RecordBatch.from_arrays([batch.column("col"), pa.array([r.tobytes() for r in made], pa.binary())], ["col", "v"])

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        rows = _rows_of(batch.column("v"), side)
        return rows.T @ rows

    def times(key: str, other: str, vectors: DataFrame) -> DataFrame:
        return stored(_products(entries, key, other, vectors, side), "svd")

    # Vectors are stored before they are joined: a stage with several steps in Python holds a worker for
    # each in every task, and workers keep their memory into the stages behind.
    right = stored(entries.select("col").distinct().mapInArrow(start, "col long, v binary"), "svd")
    for _ in range(rounds + 1):
        left = times("row", "col", right)
        q = stored(_turned(left, "row", side, _root(_matrix_sum(left, gram, side))), "svd")
        right = times("col", "row", q)  # A' Q: the rows of B'
    values, vectors = np.linalg.eigh(_matrix_sum(right, gram, side))
    order = np.argsort(values)[::-1][:rank]
    values = np.sqrt(np.maximum(values[order], 0))
    sound = values > values.max(initial=0.0) * 1e-6
    turn = vectors[:, order] * np.where(sound, 1 / np.where(sound, values, 1.0), 0.0)
    return _turned(right, "col", side, turn), values


def fit(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None, text_col: str = "text") -> Space:
    """Weights from the corpus, space and passages from the benchmark. The fitted files grow with the
    benchmark, not with the corpus; tasks map them."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark, "latent")
    passages = stored(_passages(benchmark, item_col, item_text_col, answer_col), "passages")

    # The stated query set is brought together here: the benchmark's words and passages.
    rows = sorted(((r["item_id"], r["part"], np.frombuffer(r["words"], np.uint64), np.frombuffer(r["answer"], np.uint64)) for r in passages.collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2].tobytes()))
    known = np.unique(np.concatenate([r[2] for r in rows])) if rows else np.zeros(0, np.uint64)
    vocabulary = f"{folder}/vocabulary"
    put_arrays(vocabulary, known)
    counts = {r["place"]: r["n"] for r in _document_counts(docs.select(F.col(text_col).alias("text")), vocabulary).collect()}  # a row a benchmark word
    texts = counts.pop(-1, 0)
    n = np.zeros(len(known))
    n[list(counts)] = list(counts.values())
    idf = np.log((texts + 1) / (n + 0.5)).clip(0.01)

    place = [np.searchsorted(known, r[2]) for r in rows]
    size = np.array([len(p) for p in place], np.int64)
    entries = spark.createDataFrame(pa.table({"row": np.zeros(0, np.int64), "col": np.zeros(0, np.int64), "weight": np.zeros(0)}).to_pandas(), "row long, col long, weight double")
    if rows:
        cells, tf = np.unique(np.repeat(np.arange(len(rows)), size) << 32 | np.concatenate(place), return_counts=True)
        weight = tf * idf[cells & 0xFFFFFFFF] ** 2
        norm = np.sqrt(np.bincount(cells >> 32, weight**2, len(rows)))[cells >> 32]
        entries = spark.createDataFrame(pa.table({"row": cells >> 32, "col": cells & 0xFFFFFFFF, "weight": weight / norm}))
    rank = max(1, min(rank, len(rows), len(known)))
    vectors, _ = randomised_svd(stored(entries, "entries"), rank)
    directions = np.zeros((len(known), rank), np.float32)
    for r in vectors.collect():  # a row a benchmark word
        directions[r["col"]] = np.frombuffer(r["v"])
    directions *= (idf**2)[:, None].astype(np.float32)

    own = np.array([directions[p].sum(0) for p in place], np.float32).reshape(len(rows), rank)
    told = [np.searchsorted(known, r[3]) for r in rows]
    put_arrays(f"{folder}/words", known, idf, directions.ravel())
    ids = np.array([r[0] if r[0] is not None else np.iinfo(np.int64).min for r in rows], np.int64)
    put_arrays(f"{folder}/passages", ids, size, np.concatenate([*place, np.zeros(0, np.int64)]), np.array([len(t) for t in told], np.int64),
               np.concatenate([*told, np.zeros(0, np.int64)]), own.ravel())
    return Space(f"{folder}/words", f"{folder}/passages", rank)


class Searcher:
    def __init__(self, space: Space) -> None:
        self.known, self.idf, flat = get_arrays(space.words, np.uint64, np.float64, np.float32)
        self.directions = np.concatenate([flat.reshape(-1, space.rank), np.zeros((1, space.rank), np.float32)])
        self.ids, size, words, told, answers, own = get_arrays(space.passages, *[np.int64] * 5, np.float32)
        self.words = np.split(words, np.cumsum(size)[:-1]) if len(size) else []
        self.answers = np.split(answers, np.cumsum(told)[:-1]) if len(told) else []
        self.own = own.reshape(-1, space.rank)
        self.length = np.maximum(np.linalg.norm(self.own, axis=1), 1e-12)

    def _places(self, found: Words) -> np.ndarray:
        """The place of each word in the benchmark's vocabulary; its length for other words."""
        h = found.hashes()
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, at, len(self.known))[found.codes]

    def _in_common(self, passage: np.ndarray, window: np.ndarray) -> float:
        """Weight of the heaviest common subsequence, as a share of the passage's."""
        best = np.zeros(len(window) + 1)
        for w in passage.tolist():
            taken = np.where(window == w, best[:-1] + self.idf[w], 0.0)
            best[1:] = np.maximum.accumulate(np.maximum(best[1:], taken))
        total = self.idf[passage].sum()
        return float(best[-1] / total) if total else 0.0

    def search(self, found: Words) -> Iterator[tuple[int, int, int, int, float, float]]:
        """(text, item, first word, end, share in common, share of the answer) of each hit."""
        if not len(self.own) or not len(found.codes):
            return
        place = self._places(found)
        # Blocks of STEP words, counted from each text's begin; a window is a few blocks in a row.
        n = np.diff(found.first)
        blocks = -(-n // STEP)
        text = np.repeat(np.arange(len(n)), blocks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        heads = found.first[text] + number * STEP
        of_block = np.zeros((len(heads), self.own.shape[1]), np.float32)
        group = max(1, (1 << 16) // STEP)
        ends = np.append(heads[1:], len(place))
        for i in range(0, len(heads), group):
            j = min(i + group, len(heads))
            part = self.directions[place[heads[i] : ends[j - 1]]]
            of_block[i:j] = sums(part, heads[i:j] - heads[i])
        windows = of_block.copy()
        span = WINDOW // STEP
        for k in range(1, span):
            same = text[k:] == text[:-k]
            windows[:-k][same] += of_block[k:][same]
        # A window that begins behind a text's first one and has fewer blocks lies inside another.
        keep = (number == 0) | (number + span <= blocks[text])
        text, number, windows = text[keep], number[keep], windows[keep]
        length = np.maximum(np.linalg.norm(windows, axis=1), 1e-12)
        for b in range(0, len(self.own), _BLOCK):
            unit = (self.own[b : b + _BLOCK] / self.length[b : b + _BLOCK, None]).T
            for i in range(0, len(windows), 1 << 12):
                along = windows[i : i + (1 << 12)] @ unit  # the window's length in the passage's direction
                near = (along >= COSINE * length[i : i + (1 << 12), None]) & (along >= CONTAINED * self.length[b : b + _BLOCK])
                for w, k in zip(*np.nonzero(near), strict=True):
                    d, at = int(text[i + w]), int(number[i + w]) * STEP
                    end = min(at + WINDOW, int(n[d]))
                    words = place[found.first[d] + at : found.first[d] + end]
                    share = self._in_common(self.words[b + k], words)
                    if share < PARAPHRASE:
                        continue
                    answer = self._in_common(self.answers[b + k], words) if len(self.answers[b + k]) else share
                    if share >= VERBATIM or answer >= ANSWER:
                        yield d, int(self.ids[b + k]), at, end, share, answer


@kept(2)
def _searcher(space: Space) -> Searcher:
    return Searcher(space)


HITS = "doc_id long, item_id long, first_word long, end_word long, in_common double, answer double"


def find_leaks(docs: DataFrame, space: Space, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and benchmark item that it holds: the best window. One pass over
    the texts, no shuffle."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in HITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            best: dict[tuple[int, int], tuple] = {}
            for d, item, at, end, share, answer in _searcher(space).search(_words(batch.column("text"))):
                if (d, item) not in best or best[d, item][2:] < (share, answer):
                    best[d, item] = (at, end, share, answer)
            if best:
                doc = batch.column("doc_id").take(pa.array([d for d, _ in best], pa.int64()))
                items = np.array([item for _, item in best], np.int64)
                rest = [pa.array(c, kind) for c, kind in zip(zip(*best.values(), strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([doc, pa.array(items, mask=items == np.iinfo(np.int64).min), *rest], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, HITS)


def remove_leaks(docs: DataFrame, space: Space, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose texts hold no benchmark item; all columns."""
    ship(docs.sparkSession)
    own = docs.columns
    t = own.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(own))))
    plain = plain.withColumn(f"c{t}", F.col(f"c{t}").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"c{t}"):
            clean = np.ones(batch.num_rows, bool)
            clean[[d for d, *_ in _searcher(space).search(_words(batch.column(t)))]] = False
            yield batch.filter(pa.array(clean))

    return plain.mapInArrow(run, plain.schema).toDF(*own)
