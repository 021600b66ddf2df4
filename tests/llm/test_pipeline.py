"""The pipeline over a small corpus with planted cases, stage by stage and as a whole."""

import random
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

import corpus_pipeline as pipeline  # noqa: E402
from test_jaccard_chunks_latent import brute_components, prose  # noqa: E402
from test_lm_rules import base_counts  # noqa: E402

from ledgerflow.llm import tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SECRET = "password = hunter2hunter2xyz"


def length(text):
    return len(tokens.tokenizer(PATH).encode(text, add_special_tokens=False).ids) + 1


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [(k, " ".join(prose(rng, 30)) + ". " + " ".join(prose(rng, 8)) + ".") for k in range(12)] + [(90, None), (91, "")]
    rows = [(k, " ".join(prose(rng, rng.randint(60, 400))), f"s{k % 3}") for k in range(60)]
    for k in range(12):  # near copies of the first twelve, two of each
        for j in range(2):
            words = rows[k][1].split()
            words[rng.randrange(len(words))] = "changed"
            rows.append((100 + 12 * j + k, " ".join(words), "s1"))
    rows += [(200 + k, " ".join(prose(rng, 80)) + " " + items[k][1] + " " + " ".join(prose(rng, 40)), "s2") for k in range(12)]
    rows += [(300 + k, " ".join(prose(rng, 70)) + f" {SECRET}{k} " + " ".join(prose(rng, 20)), "s0") for k in range(5)]
    rows += [(400, "too short", "s0"), (401, "", "s0"), (402, None, None), (403, "again and again " * 60, "s1")]
    rows += [(404, " ".join(prose(rng, 120)), None)] * 3 + [(None, " ".join(prose(rng, 100)), "s0")]
    rows += [(None, rows[-1][1] + " more", "s0"), (405, " ".join(prose(rng, 9000)), "s1")]
    folder = f"file://{tmp_path_factory.mktemp('corpus')}"
    docs = spark.createDataFrame([(a, b, "en", c, len(b or ""), "x") for a, b, c in rows], "doc_id long, text string, lang string, source string, n_chars long, __key string")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def read(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def good(rows):
    return [r for r in rows if base_counts(r[1])[0] >= 50 and 100 * base_counts(r[1])[4] <= 50 * base_counts(r[1])[0]]


def test_quality_keeps_what_is_good(spark, corpus):
    folder, rows, _ = corpus
    kept = pipeline.quality_rules(spark, read(spark, folder), folder)
    assert kept.columns == read(spark, folder).columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((a, b) for a, b, _ in good(rows))


def test_one_of_each_group_stays(spark, corpus):
    folder, rows, _ = corpus
    docs = read(spark, folder)
    left = pipeline.near_duplicates(spark, docs, folder)
    assert left.columns == docs.columns
    got = left.collect()
    words = [(a, b) for a, b, _ in rows if (b or "").split()]
    named = {component for _, _, component in brute_components_of_five(words)}
    assert {r["doc_id"] for r in got if (r["text"] or "").split()} == named
    many = Counter(r["doc_id"] for r in got)
    assert many[404] == 1 and many[None] == 1 and many[402] == 1 and max(many.values()) == 1
    # Again over its own result: nothing more goes.
    assert pipeline.near_duplicates(spark, left, folder).count() == len(got)


def brute_components_of_five(rows):
    import test_jaccard_chunks_latent as t

    own = t.shingles
    t.shingles = lambda text: own(text, 5)
    try:
        return brute_components(rows, 80)
    finally:
        t.shingles = own


def test_secrets_are_masked(spark, corpus):
    folder, rows, _ = corpus
    masked = {r["doc_id"]: r for r in pipeline.mask_secrets(spark, read(spark, folder), folder).collect()}
    for doc, text, _ in rows:
        if doc is not None and 300 <= doc < 400:
            assert "hunter2" not in masked[doc]["text"] and "<secret>" in masked[doc]["text"] and masked[doc]["n_chars"] == len(masked[doc]["text"])
        elif doc is not None and text is not None:
            assert masked[doc]["text"] == text
    assert len(masked) == len({a for a, _, _ in rows})


def test_whole_run(spark, corpus):
    folder, rows, items = corpus
    out = pipeline.run(spark, folder).collect()
    kept = good(rows)
    names = {component for _, _, component in brute_components_of_five([(a, b) for a, b, _ in kept])}
    texts = {a: b for a, b, _ in kept if a in names and not (a is not None and 200 <= a < 212)}
    for a in range(300, 305):
        texts[a] = texts[a].replace(f"{SECRET}{a - 300}", "<secret>")
    lengths = Counter()
    for r in out:
        lengths[r["doc_id"]] += r["length"]
    texts.pop(None, None)
    assert {k: v for k, v in lengths.items() if k is not None} == {k: length(t) for k, t in texts.items()}
    bins = Counter()
    for r in out:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 2048


def test_stages_take_no_rows(spark, corpus):
    folder, _, _ = corpus
    none = read(spark, folder).where("doc_id < 0")
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
    assert [name for name, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontaminate", "mask_secrets", "pack_sequences"]
