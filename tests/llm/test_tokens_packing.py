"""Prefix token counts and packing against the library and against plain best-fit decreasing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import packing, prefix_tokens, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "it's he'll 'rex ?'s don't I'd 'S we'VE '", "<|endoftext|>a<|startoftext|><|endoftext", "x" * 300, "aaaaaaabaaa",
    "naïve Ñandú ÀÉ", "éä Å H̱", "a\xa0b c", "日本語テキスト한국어 ไทยภาษา", "٣٤٥ 12345 ½",
    "<|ENDOFTEXT|> <|endoftext|", "İstanbul ΣΑΣ", "", "  \n ", "?!?'ll ...''s", "a\x1cb\x00c", "👩‍👧 😀😀",
    "https://foo.bar/baz?x=1&y=2", "a≠b", "'" * 9 + "s", "ﬁ ǅ", "A" * 5 + "́",
]


def count(text):
    return len(tokens.tokenizer(PATH).encode(text, add_special_tokens=False).ids)


def check(texts):
    total, steps, places = tokens.prefix_counts(PATH).count_all(pa.array(texts))
    ids, starts = tokens.token_ids(PATH).encode(pa.array(texts))
    for d, text in enumerate(texts):
        got = np.cumsum(steps[places[d] : places[d + 1]]).tolist()
        assert got == [count(text[:k]) for k in range(1, len(text) + 1)]
        assert total[d] == count(text)
        assert ids[starts[d] : starts[d + 1]].tolist() == tokens.tokenizer(PATH).encode(text, add_special_tokens=False).ids


def test_odd_texts():
    check(ODD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbeéü'.,sStlrvdm 1\n-<|>́中", max_size=40), min_size=1, max_size=4))
def test_any_text(texts):
    check(texts)


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(None, "no id", "y"), (99, None, None), (5, "again", "z"), (5, "again", "z")]
    rows += [(200 + k, "word " * (700 * k), None) for k in range(1, 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_documents(odd_docs):
    out = prefix_tokens.count_prefixes(odd_docs, PATH)
    rows = out.select("doc_id", "n_bytes", "n_tokens", F.size("prefix_steps").alias("chars")).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), count(r["text"] or ""), len(r["text"] or "")) for r in odd_docs.collect()]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def test_longest_prefixes_within_budgets(odd_docs):
    """Against the library: every prefix encoded anew."""
    library = tokens.tokenizer(PATH)
    rows = odd_docs.select("doc_id", "text").collect()
    short = {r["doc_id"]: r["text"] or "" for r in rows if r["doc_id"] not in (None, 5) and len(r["text"] or "") < 400}
    docs = odd_docs.where(F.col("doc_id").isin(list(short)))
    found = prefix_tokens.count_prefixes(docs, PATH, budgets=(0, 1, 3, 7, 2048), keep_steps=False)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "fits_0", "fits_1", "fits_3", "fits_7", "fits_2048"]
    for r in found.collect():
        text = short[r["doc_id"]]
        counts = [len(x.ids) for x in library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)]
        for b in (0, 1, 3, 7, 2048):
            assert r[f"fits_{b}"] == max(k for k, n in enumerate(counts) if n <= b), (text, b)


def test_questions_about_prefixes(odd_docs):
    steps = F.col("prefix_steps")
    out = prefix_tokens.count_prefixes(odd_docs.where("doc_id in (0, 4, 12)"), PATH)
    for r in out.select("doc_id", prefix_tokens.tokens_of_prefix(steps, 5).alias("five"), prefix_tokens.longest_prefix(steps, 3).alias("three")).collect():
        text = ODD[r["doc_id"]]
        assert r["five"] == count(text[:5])
        assert r["three"] == max(k for k in range(len(text) + 1) if count(text[:k]) <= 3)


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.integers(30, 41))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    ranges = packing.plan(histogram, capacity)
    used = {}
    for n, many in histogram.items():
        own = ranges[ranges[:, 0] == n]
        for k in range(many):
            row = own[np.searchsorted(own[:, 1], k, "right") - 1]
            used.setdefault(row[2] + k - row[1], []).append((row[3], n))
    for pieces in used.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == best_fit(lengths, capacity)


def test_pack(odd_docs):
    capacity, rows = 64, odd_docs.union(odd_docs)
    got = packing.pack(rows, PATH, capacity, keep_ids=True).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in rows.collect()]
    want = []
    for doc, text in texts:
        ids = tokens.tokenizer(PATH).encode(text, add_special_tokens=False).ids + [0]
        want += [(doc, k // capacity, k, tuple(ids[k : k + capacity])) for k in range(0, len(ids), capacity)]
    seen = [(r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got]
    assert sorted(seen, key=repr) == sorted(want, key=repr)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and r["length"] == len(r["ids"]) // 4 for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(bins) == len(best_fit([len(w[3]) for w in want], capacity))


def test_pack_nothing(odd_docs):
    assert packing.pack(odd_docs.where("doc_id < 0"), PATH).count() == 0


def test_many_pieces_of_random_lengths():
    rng = random.Random(3)
    lengths = [rng.randint(1, 2048) for _ in range(3000)]
    ranges = packing.plan({n: lengths.count(n) for n in set(lengths)}, 2048)
    bins = len(best_fit(lengths, 2048))
    assert ranges[:, 2].max() + 1 <= bins <= 1.03 * sum(lengths) / 2048 + 1
