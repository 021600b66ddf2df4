"""Token counts of every prefix of every text, so truncation and budgets need no re-encoding.

`count_prefixes` runs the prefix dynamic programme of `tokens.PrefixCounts` once per distinct piece
and lays its results along each text. `prefix_steps[i]` is what character i adds to the count of
the text up to and with it (it can be negative: a longer piece may need fewer tokens), so the sum
of the first k steps is the exact token count of the first k characters.

Rows: NULL and empty texts have 0 tokens and no steps; repeated rows stay, one result each; a NULL
id stays NULL; only the id and text columns are read, so other columns may bear any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import ship
from ledgerflow.llm.tokens import prefix_counts
from ledgerflow.llm.words import ragged, runs, slices

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def longest_fits(tokens: np.ndarray, steps: np.ndarray, places: np.ndarray, budget: int) -> np.ndarray:
    """Characters of the longest prefix of each text that has at most `budget` tokens. Counts of longer
    prefixes can be smaller, so a text's last fitting place is looked for, not its first that is too long."""
    out = np.diff(places)
    over = np.flatnonzero(tokens > budget)
    if len(over):
        sizes = out[over]  # a text with tokens has characters
        own = ragged(steps, places[over], sizes)
        heads = np.cumsum(sizes) - sizes
        count = np.cumsum(own, dtype=np.int64)
        count -= np.repeat(count[heads] - own[heads], sizes)
        out[over] = np.maximum.reduceat(np.where(count <= budget, runs(sizes) + 1, 0), heads)
    return out


def count_prefixes(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", budgets: Sequence[int] = (), keep_steps: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and prefix_steps (unless `keep_steps` is off) of each row, and for each of
    `budgets` a column fits_<budget>: the characters of the longest prefix with so many tokens at most.
    `tokenizer`: vocabulary file, at the same path on all machines. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counts(tokenizer)
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            tokens, steps, places = counter.count_all(texts)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            fits = [pa.array(longest_fits(tokens, steps, places, b), pa.int64()) for b in budgets]
            lists = [pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(steps))] if keep_steps else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, pa.array(tokens, pa.int64()), *lists, *fits], names)

    ship(docs.sparkSession)
    schema = SCHEMA + (", prefix_steps array<smallint>" if keep_steps else "") + "".join(f", fits_{b} long" for b in budgets)
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def tokens_of_prefix(steps: Column, chars: Column | int) -> Column:
    """Token count of the first `chars` characters."""
    n = F.lit(chars) if isinstance(chars, int) else chars
    return F.aggregate(F.slice(steps, F.lit(1), n), F.lit(0), lambda total, step: total + step)


def longest_prefix(steps: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix that has at most `budget` tokens."""
    most = F.lit(budget) if isinstance(budget, int) else budget
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("total"), F.lit(0).alias("best"))

    def step(state: Column, x: Column) -> Column:
        at, total = state["at"] + 1, state["total"] + x
        return F.struct(at.alias("at"), total.alias("total"), F.when(total <= most, at).otherwise(state["best"]).alias("best"))

    return F.aggregate(steps, start, step, lambda state: state["best"])
