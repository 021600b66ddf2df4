"""The Jaccard join, chunk deduplication and decontamination against brute force and plants."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import chunk_dedup, components, jaccard_join, latent_decontam
from ledgerflow.llm.words import buffers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


_SYLLABLES = ["an", "ber", "co", "dal", "en", "fi", "gor", "ha", "is", "jun", "ka", "lem", "mi", "nor", "o", "pre", "qui", "ras", "ti", "us"]
_WORDS = ["".join(random.Random(k).choices(_SYLLABLES, k=1 + k % 4)) + str(k) * (k % 7 == 0) for k in range(20000)]
_WEIGHTS = [1 / (k + 4) for k in range(20000)]


def prose(rng, n):
    return rng.choices(_WORDS, _WEIGHTS, k=n)


def shingles(text, n=4):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return [(doc, len(sets[i]), min((d for d in groups[find(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def near(spark):
    rng = random.Random(5)
    rows, base = [], [prose(rng, rng.randint(3, 160)) for _ in range(60)]
    for words in base:
        rows.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 4])):  # near copies of all distances about the threshold
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(999)}"
            rows.append(" ".join(copy))
    chain = prose(rng, 300)  # each step is linked with the next, the ends are not
    for k in range(12):
        rows.append(" ".join(f"c{j}" if j < 8 * k else w for j, w in enumerate(chain)))
    crowd = prose(rng, 200)  # a crowd of near copies and one of exact copies
    for k in range(80):
        copy = list(crowd)
        copy[rng.randrange(200)] = f"crowd{k}"
        rows.append(" ".join(copy))
    rows += [" ".join(crowd[:90])] * 50
    passage = " ".join(prose(rng, 45))  # very many documents share it, and are else apart
    rows += [f"{passage} {' '.join(prose(rng, 40))}" for _ in range(60)]
    rows += ["", None, "one", "One", "one two", "one two three", " one\ttwo\nthree ", "A b C d", "a B c D"]
    rng.shuffle(rows)
    out = [(k * 3 + 1, t) for k, t in enumerate(rows)] + [(None, " ".join(chain)), (7, " ".join(crowd)), (7, " ".join(crowd))]
    return out, spark.createDataFrame([(a, b, "x") for a, b in out], "doc_id long, text string, size string").repartition(5)


@pytest.mark.parametrize("percent", [85, 50])
def test_components_are_those_of_all_pairs(near, percent):
    rows, docs = near
    got = jaccard_join.join_similar(docs, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_components(rows, percent), key=repr)


def test_join_of_nothing(near):
    docs = near[1].where("doc_id < 0")
    assert jaccard_join.join_similar(docs).count() == 0
    assert jaccard_join.join_similar(near[1].where("text is null or text = ''")).count() == 2


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(70)] + [(2000, 2001 + k) for k in range(200)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {}
    for a, b in edges:
        if a != b:
            x, y = label.get(a, {a}), label.get(b, {b})
            for n in (both := x | y):
                label[n] = both
    assert got == {n: min(s) for n, s in label.items()}


def test_chunks_resist_shifts():
    rng = random.Random(4)
    text = " ".join(prose(rng, 4000)).encode()
    moved = text[:5000] + b"inserted words" + text[5000:]
    data, offsets = buffers(pa.array([text, moved, None, b"", b"x" * 5000], pa.binary()))
    found = chunk_dedup.chunks_of(data, offsets)
    assert (found.start[1:] == found.stop[:-1]).all() and found.start[0] == 0 and found.stop[-1] == len(data)
    first, second = (found.digest[found.text == k] for k in (0, 1))
    assert len(set(first.tolist()) - set(second.tolist())) <= 5 and len(first) > 700
    assert set(found.text.tolist()) == {0, 1, 4}
    alone = chunk_dedup.chunks_of(*buffers(pa.array([moved], pa.binary())))
    assert alone.digest.tolist() == second.tolist()  # neighbours in a slice make no difference


@pytest.fixture(scope="module")
def repeats(spark):
    rng = random.Random(6)
    passages = [prose(rng, rng.randint(51, 70)) for _ in range(40)]
    rows, planted = [], {}
    for k in range(400):
        words = prose(rng, rng.randint(60, 300))
        if k % 4 == 0:
            p = (k // 4) % 40
            at = rng.randrange(len(words))
            words[at:at] = passages[p]
            planted.setdefault(p, []).append(k)
        rows.append((k, " ".join(words) + " é", "x"))
    rows += [(900, rows[1][1], "copy"), (None, rows[2][1], "null"), (3, rows[3][1], "again"), (901, None, "n"), (902, "", "e")]
    return rows, passages, planted, spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(4)


def test_repeated_passages_are_found(repeats):
    rows, passages, planted, docs = repeats
    got = chunk_dedup.repeated_spans(docs, chunk_dedup.find_repeats(docs)).collect()
    text = {(r[0], r[2]): r[1] for r in rows}
    found = {}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 900:
            span = text[r["doc_id"], "x"][r["start"] : r["stop"]]
            found.setdefault(r["doc_id"], []).append((span, r["first_doc_id"], r["is_first"]))
    plants = {k: p for p, ks in planted.items() for k in ks}
    assert set(plants) <= set(found)
    for k, spans in found.items():
        if k in plants:  # about the whole passage, and little else
            own = " ".join(passages[plants[k]])
            assert any(span.strip() in own or own in span or len(set(span.split()) & set(own.split())) > 20 for span, _, _ in spans)
            assert all(first == min(planted[plants[k]]) and is_first == (k == first) for _, first, is_first in spans)
    # Clean documents are left alone: the copied ones are 1 and 2, and row 3 is one document.
    assert set(found) - set(plants) == {1, 2}


def test_repeats_are_removed(repeats):
    rows, passages, planted, docs = repeats
    marks = chunk_dedup.find_repeats(docs)
    out = chunk_dedup.remove_repeats(docs, marks)
    assert out.columns == docs.columns and out.count() == len(rows)
    left = {(r["doc_id"], r["start"]): r["text"] for r in out.collect()}
    for p, ks in planted.items():
        own = " ".join(passages[p])
        assert own in left[ks[0], "x"]
        assert all(own not in left[k, "x"] and len(left[k, "x"]) < len(rows[k][1]) - 100 for k in ks[1:])
    assert left[900, "copy"] == "" and left[1, "x"] == rows[1][1] and left[901, "n"] is None or left[901, "n"] == ""
    none = docs.where("doc_id < 0")
    assert chunk_dedup.repeated_spans(none, chunk_dedup.find_repeats(none)).count() == 0


@pytest.mark.parametrize("before, after", [(75, 75), (150, 0), (20, 20), (0, 50), (5, 120), (12, 12)])
def test_shared_passages_inside_copies(spark, before, after):
    """Document 1 holds a passage; 2 and its copies 3 and 4 hold it among other words."""
    rng = random.Random(before + 1000 * after)
    own, passage, head, tail = (" ".join(prose(rng, n)) for n in (120, 80, before, after))
    copy = f"{head} {passage} {tail}".strip()
    rows = [(1, f"{own} {passage}"), (2, copy), (3, copy), (4, copy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = chunk_dedup.find_repeats(docs)
    text, spans = dict(rows), {}
    for r in chunk_dedup.repeated_spans(docs, marks).collect():
        spans.setdefault(r["doc_id"], []).append((r["is_first"], r["first_doc_id"], text[r["doc_id"]][r["start"] : r["stop"]].split()))
    theirs = [(first, words) for is_first, first, words in spans[2] if not is_first]
    assert [first for first, _ in theirs] == [1] and 65 <= len(theirs[0][1]) <= 80
    assert all(first == 2 for is_first, first, _ in spans[2] if is_first)
    assert any(is_first and first == 1 and len(words) >= 65 for is_first, first, words in spans[1])
    for k in (3, 4):  # whole copies, divided where the documents they belong to change
        assert not any(is_first for is_first, *_ in spans[k])
        assert sum(len(words) for *_, words in spans[k]) >= len(copy.split()) and 1 in {first for _, first, _ in spans[k]}
        if not 15 < max(before, after) < 40:  # about LEAST_WORDS it depends on where chunks end
            assert (2 in {first for _, first, _ in spans[k]}) == (max(before, after) >= 40)
    left = {r["doc_id"]: r["text"] for r in chunk_dedup.remove_repeats(docs, marks).collect()}
    assert left[1] == text[1] and left[3] == left[4] == ""
    for part in (head, tail):  # what document 1 never had is still there, once
        assert part in left[2]
    assert len(left[2].split()) <= before + after + 15


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(8)
    items = [(k, " ".join(prose(rng, rng.randint(14, 60))) + ". " + " ".join(prose(rng, 6)) + ".") for k in range(50)]
    items += [(50, " ".join(prose(rng, 200))), (51, ""), (52, None), (None, " ".join(prose(rng, 30)))]
    rows, planted = [], {}
    for k in range(600):
        words = prose(rng, rng.randint(5, 500))
        if k % 5 == 0:
            item, text = items[(k // 5) % 50]
            part = text.split()
            kind = (k // 5) % 3
            if kind == 1:
                part = [w.upper().strip(".") + rng.choice(["", ",", "!"]) for w in part]
            if kind == 2 and k < 300:  # a paraphrase: every sixth word is another one
                part = [f"other{rng.randrange(99)}" if j % 6 == 3 else w for j, w in enumerate(part)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
            planted[k] = item
        rows.append((k, " ".join(words), "x"))
    rows.append((700, " ".join(prose(rng, 50)) + " " + items[50][1], "long"))
    planted[700] = 50
    rows += [(701, None, "n"), (702, "", "e"), (None, items[0][1], "i")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    return rows, planted, bench, spark.createDataFrame(rows, "doc_id long, text string, answer string").repartition(3)


def test_leaks_are_found_and_nothing_else(leaks):
    rows, planted, bench, docs = leaks
    space = latent_decontam.fit(docs, bench)
    got = latent_decontam.find_leaks(docs, space).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    missed = {k for k, item in planted.items() if (k, item) not in found}
    assert not missed
    assert {d for d, _ in found} == {*planted, None}
    kept = latent_decontam.remove_leaks(docs, space)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in rows if r[0] is not None and r[0] not in planted)


def test_search_finds_what_all_windows_hold(leaks):
    """Recall of the latent search against the same checks on every window and passage."""
    rows, _, bench, docs = leaks
    space = latent_decontam.fit(docs, bench)
    searcher = latent_decontam.Searcher(space)
    sample = [t for _, t, _ in rows[:200]]
    found = {(d, item) for d, item, *_ in searcher.search(latent_decontam._words(pa.array(sample)))}
    every = set()
    for d, text in enumerate(sample):
        words = latent_decontam._words(pa.array([text]))
        place = searcher._places(words)
        for at in range(0, max(1, len(place) - latent_decontam.WINDOW + latent_decontam.STEP), latent_decontam.STEP):
            window = place[at : at + latent_decontam.WINDOW]
            for k, passage in enumerate(searcher.words):
                share = searcher._in_common(passage, window)
                if share >= latent_decontam.PARAPHRASE:
                    answer = searcher._in_common(searcher.answers[k], window) if len(searcher.answers[k]) else share
                    if share >= latent_decontam.VERBATIM or answer >= latent_decontam.ANSWER:
                        every.add((d, int(searcher.ids[k])))
    assert every and len(found & every) >= 0.9 * len(every) and found <= every


def test_randomised_svd_spans_what_numpy_finds(spark):
    rng = np.random.default_rng(1)
    matrix = rng.standard_normal((30, 5)) @ rng.standard_normal((5, 40)) + 0.01 * rng.standard_normal((30, 40))
    r, c = np.nonzero(np.ones_like(matrix))
    entries = spark.createDataFrame(pa.table({"row": r, "col": c, "weight": matrix.ravel()}))
    vectors, values = latent_decontam.randomised_svd(entries, rank=5, spare=4, rounds=2)
    own = np.zeros((40, 5))
    for x in vectors.collect():
        own[x["col"]] = np.frombuffer(x["v"])
    _, want, vt = np.linalg.svd(matrix)
    assert values == pytest.approx(want[:5], rel=1e-6)
    assert np.abs(own.T @ own - np.eye(5)).max() < 1e-6
    assert np.linalg.norm(own @ (own.T @ vt[:5].T) - vt[:5].T) < 1e-5


def python_steps(plan):
    """The most steps in Python that one task of a physical plan runs: those between two exchanges."""
    most, path = 0, []
    for line in plan.splitlines():
        name = re.search(r"[A-Za-z]", line)
        if not name:
            continue
        depth, text = name.start(), line[name.start() :]
        path = [x for x in path if x[0] < depth]
        n = 0 if "Exchange" in text.split(" ")[0] else (path[-1][1] if path else 0) + text.startswith("MapInArrow")
        path.append((depth, n))
        most = max(most, n)
    return most


def test_vectors_take_one_worker_a_task(spark, monkeypatch):
    """Several steps in Python in one stage hold as many workers in every task, whose memory stays."""
    plans, store = [], latent_decontam.stored

    def seen(df, *args, **named):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, *args, **named)

    monkeypatch.setattr(latent_decontam, "stored", seen)
    entries = spark.createDataFrame([(r, c, 1.0 + r * c) for r in range(4) for c in range(5)], "row long, col long, weight double")
    vectors, _ = latent_decontam.randomised_svd(entries, rank=2, spare=2)
    assert vectors.count() == 5 and max(map(python_steps, plans)) == 1


def test_no_benchmark_and_no_documents(leaks):
    _, _, bench, docs = leaks
    for d, b in ((docs, bench.where("item_id < 0")), (docs.where("doc_id < 0"), bench), (docs, bench.where("item_id in (51, 52)"))):
        space = latent_decontam.fit(d, b)
        assert latent_decontam.find_leaks(d, space).count() == 0 and latent_decontam.remove_leaks(d, space).count() == d.count()
