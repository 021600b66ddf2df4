"""Phrase mining, source divergence and licence scan against brute force."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from ledgerflow.llm import divergence, licenses, phrases
from ledgerflow.llm.license_rules import RULES, WINDOW
from ledgerflow.llm.words import gathered

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3, 4):
                f.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    many = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    out = defaultdict(list)
    for (lang, p), a in many.items():
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        inside = any(
            m == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (m, q), b in many.items()
        )
        if not inside:
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return {
        (lang, k + 1, p.decode(), -a, l, r, n[lang], -score) for lang, found in out.items() for k, (score, a, p, l, r) in enumerate(sorted(found)[:top])
    }


@pytest.fixture(scope="module")
def talk(spark):
    words = "a b cc dé EE f g h".split()
    rows = [(" ".join(words[(i * j + j // 3) % 8] for j in range(i % 40)) + ("." if i % 3 else ", x y! ") * (i % 4), ["en", "es", "es en", None, "und"][i % 5]) for i in range(400)]
    rows += [("New York City hall is big; new york city", "en")] * 30 + [("x\ty\x0bz\x00q", "en"), (None, "fr"), ("", None), ("w " * 50_000, "long"), ("\n.,", "en"), ("es", "en"), ("en", "es")]
    return rows


@pytest.mark.parametrize(("least", "top", "trigger", "held"), [(5, 2000, 16, 2_000_000), (2, 7, 2, 50), (30, 3, 1, 10)])
def test_phrases(spark, talk, monkeypatch, least, top, trigger, held):
    monkeypatch.setattr(phrases, "TRIGGER", trigger)
    monkeypatch.setattr(phrases, "HELD", held)
    docs = spark.createDataFrame([(*r, "p", 1) for r in talk], "text string, lang string, phrase string, freq int").repartition(5)
    got = phrases.mine(docs, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_phrases(talk, least, top)


def test_chunks_overlap_and_depend_on_content(spark):
    """The same passage in different surroundings gives the same inner chunks, and each word is owned once."""
    passage = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(f"{head} {passage} {tail}", "en") for head, tail in (("", ""), ("p q r", "s"), ("zz " * 17, "t u"))], "text string, lang string")
    rows = phrases.parse(docs).collect()
    assert sum(r["own"] * r["freq"] for r in rows) == sum(len(d["text"].split()) for d in docs.collect())
    assert sum(r["freq"] == 3 for r in rows) >= 5
    assert all(len(r["chunk"].split()) <= r["own"] + phrases.ORDER - 1 for r in rows)


def test_chunks_are_counted_many_at_a_time(spark, monkeypatch):
    """Small batches of chunks are brought together before they are counted; no row is lost."""
    sizes, grams = [], phrases._grams_of
    rows = [("x" * (k % 7), k) for k in range(50)] + [(None, 50), ("", 51)]
    batches = [pa.RecordBatch.from_pylist([{"text": t, "k": k} for t, k in rows[i : i + 3]], pa.schema([("text", pa.string()), ("k", pa.int64())])) for i in range(0, len(rows), 3)]
    out = list(gathered(iter([*batches, batches[0].slice(0, 0)]), "text", 40))
    assert [(r["text"], r["k"]) for b in out for r in b.to_pylist()] == rows and list(gathered(iter([]), "text", 40)) == []
    assert len(out) < len(batches) / 3 and all(sum(len(t or "") for t in b.column("text").to_pylist()) >= 40 for b in out[:-1])

    class Chunks:
        def mapInArrow(self, run, schema):  # noqa: N802
            many = [pa.RecordBatch.from_pydict({"lang": ["en"] * 2, "own": pa.array([1, 1], pa.int32()), "chunk": ["a b c ", "b c d "], "freq": pa.array([1, 1])})] * 20
            sizes.extend(b.num_rows for b in run(iter(many)))
            raise StopIteration

    calls = []
    monkeypatch.setattr(phrases, "_grams_of", lambda batch: calls.append(batch.num_rows) or grams(batch))
    monkeypatch.setattr(phrases.Frequent, "holds", lambda self, hashes, where: where)
    with pytest.raises(StopIteration):
        phrases._phrase_counts(Chunks(), [phrases.Frequent("", frozenset(), 1)] * 3, 1)
    assert calls == [40] and sizes


def test_phrases_of_no_rows(spark):
    assert phrases.mine(spark.createDataFrame([], "text string, lang string")).collect() == []


def brute_divergence(rows, least, top):
    place, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        docs.update({(lang, t) for t in w})
        for t in w:
            place[lang, source, t] += 1
    out = set()
    for lang in {x for x, _ in groups}:
        kept = [t for (x, t), d in docs.items() if x == lang and d >= least]
        sources = sorted(s for x, s in groups if x == lang)
        count = {s: {t: place[lang, s, t] for t in kept} for s in sources}
        count[None] = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in count.items()}
        f = lambda a, b, t: (p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t])
        for s in sources:
            pairs = sorted((-sum(f(s, o, t) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(s, None, t), t.encode()) for t in kept if count[s][t] > 0 and p[s][t] > p[None][t])[:top]
            for part, items in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(items)}
    return out


@pytest.mark.parametrize(("least", "top", "held", "block"), [(10, 10, 1_500_000, 1 << 20), (3, 2, 20, 8), (10_000, 10, 100, 64)])
def test_divergence(spark, monkeypatch, least, top, held, block):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "BLOCK", block)
    words = "the of Über été x1y zzz q w".split()
    rows = [(" ".join(words[(i * j + i) % (3 + i % 6)] for j in range(i % 30)), ["en", "de", None][i % 3], f"s{i % 7}" if i % 4 else "hot") for i in range(500)]
    rows += [(None, "en", None), ("", None, ""), ("a " * 100_000, "en", "long"), ("12 . ,", "one", "only"), ("same row", "en", "hot"), ("same row", "en", "hot")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "text string, lang string, source string, key string").repartition(4)
    got = divergence.audit(docs, least, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(set(out)) and set(out) == brute_divergence(rows, least, top)


def test_divergence_of_no_rows_and_large_counts(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []
    import numpy as np

    counts, total = np.array([0, 5, 10**13]), 3 * 10**13
    assert divergence.shares(counts, np.int64(total), 7).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 14) for c in counts]


NOTICES = [
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3 or any later version.",
    "CC BY-NC 4.0 and CC BY 4.0, cc by", "Released under the MIT License. MIT license MIT LICENSE mit", "GNU General Public", "gnu general-public_license v2",
    "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: MIT", "Creative Commons Attribution-NonCommercial-ShareAlike 3.0", "", None, "mit", "é",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and", "GNU Lesser General Public License v2.1 or later",
    "redistribute it and/or modify it under the terms of the GNU General Public License as published", "mit LICENSEd and mıt license", "all rights reserved. " * 50,
    "distributed under the terms of the Mozilla Public License 2.0; subject to BSD 3-Clause License", "cc cc by apache apache license license",
]


def brute_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    hits = []
    for i in range(len(w)):
        ahead = "".join(f" {x} " for x in w[i : i + WINDOW])
        for k, r in enumerate(RULES):
            if w[i] == r.first and r.need in w[i : i + WINDOW] and (m := re.match(r.pattern, ahead)):
                hits.append((i, -(i + len(m[0].split())), -r.priority, k))
    hits.sort()
    outer = [h for n, h in enumerate(hits) if not any(-g[1] >= -h[1] for g in hits[:n])]
    kept = []
    for n, h in enumerate(outer):
        beside = ([outer[n - 1]] if n and h[0] < -outer[n - 1][1] else []) + ([outer[n + 1]] if n + 1 < len(outer) and outer[n + 1][0] < -h[1] else [])
        if not any(g[2] < h[2] for g in beside):
            kept.append(h)
    base = [h for h in hits if RULES[h[3]].base]
    labels = {RULES[h[3]].label for h in [*kept, *base]}
    score = max([0.0, *(RULES[h[3]].weight for h in [*kept, *base])])
    starts = [h[0] for h in base]
    return len(w), len(base), min(starts, default=None), max(starts, default=None), sorted({RULES[h[3]].label for h in base}), sorted(labels), score


def test_licenses(spark):
    texts = [*NOTICES, *(f"{a} {b}" for a in NOTICES[:9] for b in NOTICES[4:9]), " ; ".join(x or "" for x in NOTICES), "plain words " * 40_000 + "mit license", "mit license " * 3000]
    docs = spark.createDataFrame([(None if i == 3 else i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string").repartition(4)
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts)
    want = Counter(str((None if i == 3 else i, *brute_licenses(t))) for i, t in enumerate(texts) if len(t or "") < 20_000)
    long = {i for i, t in enumerate(texts) if len(t or "") >= 20_000}
    assert Counter(str(tuple(r)) for r in rows if r["doc_id"] not in long) == want
    far, many = sorted((r for r in rows if r["doc_id"] in long), key=lambda r: r["doc_id"])
    assert (far["n_words"], far["n_base"], far["first_word"], far["labels"]) == (80_002, 1, 80_000, ["mit"])
    assert (many["n_base"], many["first_word"], many["last_word"]) == (3000, 0, 5998)
    assert len(RULES) > 300 and licenses.scan(docs.where("doc_id < 0")).count() == 0


def test_license_rules_run_in_sql_functions_only(spark):
    plan = licenses.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
