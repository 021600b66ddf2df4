"""The n-gram model and the line rules against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ledgerflow.llm import line_rules, ngram_lm, queries
from ledgerflow.llm.hash_files import bucket_of
from ledgerflow.llm.words import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END, BEGIN = "</s>", "<s>"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return [*WORD.findall(lower(text)), END]


class KneserNey:
    """Textbook form with dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.raw = Counter(t for x in texts for t in tokens(x))
        grams = Counter()
        for x in texts:
            row = [BEGIN] * (order - 1) + tokens(x)
            grams.update(tuple(row[i : i + order]) for i in range(len(row) - order + 1))
        self.counts = {order: grams}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.after = {n: defaultdict(list) for n in self.counts}
        for n, c in self.counts.items():
            for g, k in c.items():
                self.after[n][g[:-1]].append(k)
        self.off = {}
        for n, c in self.counts.items():
            few = [sum(v == k for v in c.values()) for k in range(1, 5)]
            if all(few):
                y = few[0] / (few[0] + 2 * few[1])
                off = [k - (k + 1) * y * few[k] / few[k - 1] for k in (1, 2, 3)]
                self.off[n] = [0, *(min(max(d, 0.01), k) for k, d in zip((1, 2, 3), off, strict=True))]
            else:
                self.off[n] = [0, 0.5, 1.0, 1.5]

    def p(self, context, word):
        n = len(context) + 1
        below = self.p(context[1:], word) if context else 1 / (len(self.raw) + 1)
        seen = self.after[n].get(tuple(context))
        if not seen:
            return below
        k, total, off = self.counts[n].get((*context, word), 0), sum(seen), self.off[n]
        return max(k - off[min(k, 3)], 0) / total + sum(off[min(v, 3)] for v in seen) / total * below

    def score(self, text):
        row = [BEGIN] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(row[i : i + self.order - 1], row[i + self.order - 1])) for i in range(len(row) - self.order + 1))

    def base(self, text):
        n = sum(self.raw.values())
        return sum(math.log10((self.raw[t] + 0.1) / (n + 0.1 * (len(self.raw) + 1))) for t in tokens(text))


@pytest.fixture(scope="module")
def sample(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").limit(120).select("doc_id", "text").cache()


@pytest.mark.parametrize("order", [2, 3])
def test_scores_are_those_of_the_textbook(spark, sample, order):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    odd = [(None, None), (None, ""), (9000, "Zzz unseen-word THE the the the"), (9001, "x " * 3000), (3, rows[0][1]), (3, rows[0][1])]
    train = [r for r in rows if r[0] % 3] + odd[:3] + [(1, "the of the of and")] * 300
    schema = "doc_id long, text string"
    model = ngram_lm.train(spark.createDataFrame(train, schema), order)
    every = rows + odd
    got = ngram_lm.score(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(every)], schema), model).collect()
    brute = KneserNey([t for _, t in train], order)
    assert len(got) == len(every) and model.totals[0][1] == sum(brute.raw.values()) and model.totals[0][0] == len(brute.raw)
    for r in got:
        text = every[r["doc_id"]][1]
        own = tokens(text)
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(t in brute.raw for t in own))
        assert r["score"] == pytest.approx(brute.score(text), rel=1e-9) and r["base_score"] == pytest.approx(brute.base(text), rel=1e-9)


def test_registered_query_scores_with_two_words_of_context(spark, sample, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in sample.limit(16).collect()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_kneser_ney(spark, str(tmp_path)).collect()
    brute = KneserNey([t for k, t in rows if zlib.crc32(str(k).encode()) % 10], 3)
    assert len(got) == len(rows) and len({r["held_out"] for r in got}) == 2
    for r in got:
        assert r["score"] == pytest.approx(brute.score(dict(rows)[r["doc_id"]]), rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_slices_of_a_task_are_added_up(sample, order):
    texts = [r["text"] for r in sample.limit(20).collect()]
    slices = [words_of(pa.array(texts), True)] * 5
    most = len(ngram_lm._count_slice(slices[0], order)[1][0])
    once, whole, parts = (list(ngram_lm._count_task(iter(x), order, 2, n)) for x, n in ((slices[:1], 10 * most), (slices, 10 * most), (slices, most - 1)))
    assert len(whole) == 1 and [r[2:6] for r in whole[0]] == [r[2:6] for r in once[0]]  # the same n-grams, once
    assert len(parts) > 1
    for sent in (whole, parts):
        total = sum(np.frombuffer(r[6], np.uint32).sum() for rows in sent for r in rows)
        assert total == 5 * sum(np.frombuffer(r[6], np.uint32).sum() for r in once[0])


def test_mixing_is_one_to_one():
    for width in (8, 13, 38, 62):
        some = np.unique(np.random.default_rng(1).integers(0, 1 << width, 3000, dtype=np.uint64))
        out = ngram_lm.mixed(some, width)
        assert len(np.unique(out)) == len(some) and int(out.max()) < 1 << width
        assert (ngram_lm.unmixed(out, width) == some).all()


@pytest.mark.parametrize(("level", "width", "bits"), [(2, 9, 2), (3, 16, 1), (3, 31, 2)])
def test_files_of_ngrams_hold_them_in_few_bytes(tmp_path, level, width, bits):
    """Every n-gram, and no other, is found; less than 8 bytes are sent for one."""
    rng = np.random.default_rng(2)
    whole = (level - 1) * width
    context = ngram_lm.mixed(rng.integers(0, 1 << min(whole, 14), 30_000, dtype=np.uint64), whole)
    context = context[context >> np.uint64(whole - bits) == 1]
    word = rng.integers(2, 1 << min(width, 10), len(context), dtype=np.uint64)
    grams = ngram_lm._added(context, word, None, level, width)
    pairs, places = np.unique(np.stack([context, word]), axis=1, return_counts=True)
    assert (np.stack(grams[:2]) == pairs).all() and (grams[2] == places).all()
    (row,) = ngram_lm._send_grams(level, grams, bits, width)
    sent = ngram_lm._batch([row]).to_pylist()
    assert sum(len(x) for x in sent[0].values() if isinstance(x, bytes)) < 8 * len(places)
    stats = ngram_lm._merge(sent * 2, level, 1, str(tmp_path), bits, width)
    assert stats[:2] == [len(places), 2 * places.sum()]
    held = ngram_lm.Grams(ngram_lm.get_arrays(f"{tmp_path}/{level}/000001", *ngram_lm.GRAMS))
    open_bits = np.uint64((1 << whole - bits) - 1)
    key, own = held.whole(whole - bits)
    assert sorted(zip(key.tolist(), own.tolist(), strict=True)) == sorted(zip((pairs[0] & open_bits).tolist(), pairs[1].tolist(), strict=True))
    vocabulary = ngram_lm.Vocabulary(str(tmp_path), frozenset(), bits, width)
    scorer = ngram_lm.Scorer(ngram_lm.Model(vocabulary, level, frozenset({(level, 1)}), ((0,) * 6,) * (level + 1)))
    asked = np.concatenate([pairs, [pairs[0], pairs[1] ^ np.uint64(1)]], axis=1)
    count, total, left = scorer._counts(level, *asked)
    real, sums = dict(zip(map(tuple, pairs.T.tolist()), (2 * places).tolist(), strict=True)), Counter()
    for (c, _), n in real.items():
        sums[c] += n
    assert count.tolist() == [real.get(x, 0) for x in map(tuple, asked.T.tolist())]
    assert total.tolist() == [sums[c] for c in asked[0].tolist()] and (left > 0).all()


def test_probabilities_sum_to_one(spark):
    texts = ["a b c a b", "b c d", "a a a b", "d c b a"]
    brute = KneserNey(texts, 2)
    for context in ("a", "b", "d", BEGIN):
        assert sum(brute.p([context], w) for w in [*brute.raw, "unknown"]) == pytest.approx(1.0)


def test_model_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = ngram_lm.train(none)
    got = ngram_lm.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (got["n_tokens"], got["n_known"], got["base_score"], got["score"]) == (3, 0, 0.0, 0.0)
    assert ngram_lm.score(none, model).count() == 0


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def good(k):
    return "\n".join(f"Own line {k} number {j} with words {k * 7 + j} and {k}-{j} more é" for j in range(10))


COMMON = "Read more about our cookies here\nSubscribe to the  newsletter NOW"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, good(k) + "\n" + COMMON, "a") for k in range(30)]  # two lines in 30 documents of one host
    rows += [(100 + k, good(100 + k), "b") for k in range(30)]
    rows += [(200 + k, (COMMON.upper() + "\n") * 6 + f"short {k}", "a") for k in range(20)]  # little else
    rows += [(300, good(1) + "\n" + COMMON, "a"), (400, good(1) + "\n" + COMMON, "a")]  # copies
    rows += [(500, None, "a"), (501, "", None), (None, good(501), None), (502, "w " * 400, "b"), (503, "a|b # *\n" * 3 + "x\n \nx", "c")]
    rows += [(504, good(504), "d")] * 40  # one text, many rows: its lines are in one document
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'z' as kept", "1 as c1")


def test_line_rules(pages):
    frequent = line_rules.frequent_lines(pages, most_docs=20, most_share=0.3)
    got = line_rules.assess(pages, frequent).collect()
    rows = pages.collect()
    assert len(got) == len(rows)
    texts = defaultdict(set)
    for r in rows:
        texts[r["doc_id"]].add(r["text"])
    for r in got:
        (text,) = texts[r["doc_id"]]
        own = base_counts(text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == own
        assert r["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0])
    by_id = {r["doc_id"]: r for r in got}
    # Both lines go in all documents of the host but one.
    removed = [by_id[k]["n_removed_lines"] for k in range(30)] + [by_id[200 + k]["n_removed_lines"] for k in range(20)]
    assert sorted(set(removed)) in ([2, 12], [0, 2, 12], [1, 2, 12], [2, 6, 12], [0, 2, 12]) and sum(x in (2, 12) for x in removed) >= 48
    assert all(by_id[k]["kept"] and by_id[k]["words_left"] >= by_id[k]["n_words"] - 11 for k in range(30))
    assert all(not by_id[200 + k]["kept"] for k in range(20))
    assert all(by_id[100 + k]["kept"] and by_id[100 + k]["n_removed_lines"] == 0 for k in range(30))
    assert by_id[504]["kept"] and by_id[504]["n_removed_lines"] == 0 and by_id[None]["kept"]
    assert not by_id[500]["kept"] and not by_id[501]["kept"] and by_id[502]["base_failed"]


def brute_verdicts(rows, most_docs, most_share, many_docs):
    """doc_id, removed lines, words left, kept of each row, from sets of whole texts and lines."""
    lines = lambda t: [x for x in (tuple(w.translate(LOW_TABLE) for w in WORD.findall(line)) for line in t.split("\n")) if x]
    hosts, holders = defaultdict(set), defaultdict(set)
    for r in rows:
        text = r["text"] or ""
        hosts[r["source"]].add(text)
        for line in lines(text):
            holders[r["source"], line].add(text)
    digest = lambda t: xxhash.xxh3_64_intdigest(t.encode())
    stays = {
        k: min(v, key=digest) for k, v in holders.items()
        if len(k[1]) >= line_rules.LINE_WORDS and len(v) > most_docs and len(v) > min(most_share * len(hosts[k[0]]), many_docs)
    }
    out = Counter()
    for r in rows:
        text = r["text"] or ""
        n, _, _, _, repeated = base_counts(r["text"])
        gone = [x for x in lines(text) if stays.get((r["source"], x), text) != text]
        left = n - sum(map(len, gone))
        failed = n < 50 or 100 * repeated > 50 * n
        out[r["doc_id"], len(gone), left, not failed and not (gone and (left < 50 or left < line_rules.LEAST_SHARE * n))] += 1
    return out


LOW_TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize(("most_docs", "most_share", "many_docs"), [(20, 0.3, 10_000), (5, 0.9, 10_000), (5, 0.9, 25), (3, 0.0, 10_000), (20, 0.01, 1)])
def test_verdicts_equal_brute_force(pages, most_docs, most_share, many_docs):
    found = line_rules.assess(pages, line_rules.frequent_lines(pages, most_docs, most_share, many_docs=many_docs))
    got = Counter(tuple(r) for r in found.select("doc_id", "n_removed_lines", "words_left", "kept").collect())
    assert got == brute_verdicts(pages.collect(), most_docs, most_share, many_docs)


def test_kept_rows_lose_the_lines(pages):
    frequent = line_rules.frequent_lines(pages, most_docs=20, most_share=0.3)
    verdict = {r["doc_id"]: r for r in line_rules.assess(pages, frequent).collect()}
    kept = line_rules.keep_good(pages, frequent)
    assert kept.columns == pages.columns and kept.count() == sum(verdict[r["doc_id"]]["kept"] for r in pages.collect())
    for r in kept.collect():
        v = verdict[r["doc_id"]]
        assert len(WORD.findall(r["text"])) == v["words_left"] and r["c1"] == 1 and r["kept"] == "z"
        if v["n_removed_lines"] == 2 and r["doc_id"] is not None and r["doc_id"] < 100:
            assert r["text"].rstrip("\n") == good(r["doc_id"])
        if not v["n_removed_lines"]:
            assert r["text"] in {x["text"] for x in pages.collect()}


def test_no_rows(pages):
    none = pages.where("doc_id < 0")
    frequent = line_rules.frequent_lines(none)
    assert line_rules.assess(none, frequent).count() == 0 and line_rules.keep_good(none, frequent).count() == 0


def test_documents_of_one_host_spread_over_buckets(spark):
    host, digest = np.full(4000, 5, np.uint64), np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    trio = np.column_stack([line_rules._with_host(host, host), host, digest])
    share = np.bincount(bucket_of(line_rules._dealt(trio), 5), minlength=32)
    assert share.min() > 60 and share.max() < 200
    assert (line_rules._dealt(trio) == line_rules._dealt(trio.copy())).all()
    # 1 % of the 2,600 distinct documents of the host is 26: a line of 26 stays, one of 27 goes.
    rows = [(f"own words of {k}\n" + "this is line one\n" * (k < 26) + "this is line two\n" * (k < 27), "h") for k in range(2600)]
    docs = spark.createDataFrame(rows + rows[:900], "text string, source string").repartition(3)
    found = line_rules.frequent_lines(docs)
    texts = pa.array([t for t, _ in rows[:27]])
    v = line_rules._judge(texts, pa.array(["h"] * 27), found, line_rules.LINE_WORDS, False)
    assert v.removed.sum() == 26 and v.removed.max() == 1
