"""Licence notices in texts, by ordered signature rules. All of it is built from SQL functions.

A text becomes its words. The keyword prefilter finds the places of words that some rule begins
with; texts without any are done. At each such place the rules of that word, as far as a second word
of theirs stands in the window of words from there on, are matched as patterns. So the work for a
place is bounded, and no pattern runs over a whole text.

Detections are resolved in order of their begin (the longer first, then the higher priority, then
the earlier rule): one that lies in another is left out, and of two that overlap in part the one of
higher priority stays. That is one walk over the sorted detections, which keeps only how far the
text is covered, the detection before, and the labels so far.

Rows: a NULL or empty text has no words and no detections; a NULL id stays NULL; repeated rows stay,
one result each; only the id and text columns are read; very long texts take time in proportion.
"""

from __future__ import annotations

import json
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.license_rules import RULES, WINDOW

#: What stands between words once A-Z is lower-cased.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    none = F.array().cast("array<string>")
    return _let(F.trim(F.regexp_replace(low, BETWEEN, " ")), lambda plain: F.when(plain == "", none).otherwise(F.split(plain, " ")))


def _rules() -> Column:
    """First word -> its rules: one constant, so that plans stay small."""
    by: dict[str, list[dict]] = {}
    for number, r in enumerate(RULES):
        by.setdefault(r.first, []).append({**r._asdict(), "need": f" {r.need} ", "pattern": f"^{r.pattern}", "rule": number})
    kind = "map<string,array<struct<need:string,pattern:string,label:string,priority:int,weight:double,rule:int,base:boolean>>>"
    return F.from_json(F.lit(json.dumps(by)), kind)


FIRST = sorted({r.first for r in RULES})


def _at(ws: Column, place: Column) -> Column:
    """Detections that begin at a place of the text (from 0), in an order-ready form."""
    window = F.concat(F.lit(" "), F.array_join(F.slice(ws, place + 1, F.lit(WINDOW)), "  "), F.lit(" "))

    def matched(window: Column) -> Column:
        gated = F.filter(F.element_at(_rules(), F.get(ws, place)), lambda r: F.contains(window, r["need"]))

        def one(r: Column) -> Column:
            hit = F.call_function("regexp_extract", window, r["pattern"], F.lit(0))
            size = (F.char_length(hit) - F.char_length(F.replace(hit, F.lit(" "), F.lit("")))) / 2
            stop = place + size.cast("int")
            return F.struct(
                place.alias("start"), (-stop).alias("neg_stop"), (-r["priority"]).alias("neg_priority"), r["rule"].alias("rule"),
                r["label"].alias("label"), r["weight"].alias("weight"), r["base"].alias("base"),
            )

        return F.filter(F.transform(gated, one), lambda d: -d["neg_stop"] > d["start"])

    return _let(window, matched)


def detections(ws: Column) -> Column:
    """All detections in an array of words: start, neg_stop, neg_priority, rule, label, weight, base;
    sorted by these."""
    places = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).isin(FIRST))
    found = F.sort_array(F.flatten(F.transform(places, lambda i: _at(ws, i))))
    return F.when(F.exists(ws, lambda w: w.isin(FIRST)), found).otherwise(F.array().cast(_ROW))


_ROW = "array<struct<start:int,neg_stop:int,neg_priority:int,rule:int,label:string,weight:double,base:boolean>>"


def _kept(found: Column) -> Column:
    """struct(labels, score) of what stays of sorted detections."""
    begin = F.struct(
        F.lit(-1).alias("reach"), F.lit(-1).alias("stop"), F.lit(0).alias("priority"), F.lit("").alias("label"), F.lit(0.0).alias("weight"),
        F.lit(True).alias("beaten"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"),
    )

    def settled(s: Column, beaten: Column) -> tuple[Column, Column]:
        """Labels and score with the detection before taken in, unless it is beaten."""
        known = F.array_contains(s["labels"], s["label"])
        labels = F.when(beaten | known, s["labels"]).otherwise(F.concat(s["labels"], F.array(s["label"])))
        return labels, F.when(beaten, s["score"]).otherwise(F.greatest(s["score"], s["weight"]))

    def step(s: Column, d: Column) -> Column:
        stop, priority = -d["neg_stop"], -d["neg_priority"]
        overlaps = d["start"] < s["stop"]
        labels, score = settled(s, s["beaten"] | (overlaps & (priority > s["priority"])))
        after = F.struct(
            stop.alias("reach"), stop.alias("stop"), priority.alias("priority"), d["label"].alias("label"), d["weight"].alias("weight"),
            (overlaps & (s["priority"] > priority)).alias("beaten"), labels.alias("labels"), score.alias("score"),
        )
        return F.when(stop <= s["reach"], s).otherwise(after)

    def finish(s: Column) -> Column:
        labels, score = settled(s, s["beaten"])
        return F.struct(labels.alias("labels"), score.alias("score"))

    return F.aggregate(found, begin, step, finish)


def _result(ws: Column) -> Column:
    def of(found: Column) -> Column:
        base = F.filter(found, lambda d: d["base"])
        starts = F.transform(base, lambda d: d["start"])
        plain = F.array_distinct(F.transform(base, lambda d: d["label"]))

        def whole(kept: Column) -> Column:
            best = F.when(F.size(base) > 0, F.greatest(kept["score"], F.array_max(F.transform(base, lambda d: d["weight"])))).otherwise(kept["score"])
            return F.struct(
                F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
                F.sort_array(plain).alias("base_labels"), F.sort_array(F.array_union(plain, kept["labels"])).alias("labels"), best.alias("score"),
            )

        return _let(_kept(found), whole)

    return _let(detections(ws), of)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels (sorted arrays), score.

    n_base: places of base phrases, and first_word and last_word their first and last; labels: of the
    base phrases and of the detections that stay; score: the greatest weight among them, 0 without."""
    found = F.transform(F.array(words(F.col(text_col))), lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), _result(ws).alias("r")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.element_at(found, 1).alias("found"))
    return rows.select("doc_id", "found.n_words", "found.r.*")
