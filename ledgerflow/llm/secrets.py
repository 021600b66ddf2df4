"""Secrets in texts: shaped keys by pattern, unshaped ones by the entropy of sliding windows.

All of it is built from SQL functions. A candidate is a maximal run of characters that keys are
made of. Of a candidate's characters the entropy of each window of `WINDOW` is followed: with
c(x) the count of x in the window, S = sum of c * log2 c, and entropy = log2 WINDOW - S / WINDOW. One
step takes the oldest character out and the next one in, so S changes by two terms only. A
candidate is a secret if some window exceeds the limit of the candidate's character class and no
rule of the allow-list names it; a placeholder in it hides only the windows that touch it. No step
depends on a run's length, and no pattern repeats a group, so runs of any length are safe.

Rows: a NULL text is an empty one, and has no spans; repeated rows stay, one result each; a NULL id
stays NULL; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three shapes that are always reported, and the kinds' order.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 8
#: A run of 16 (32) or more is what the open-ended shape finds and then keeps.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed", "entropy_letters", "entropy_digits")

#: Characters of a sliding window; a candidate is at least that long.
WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: Least entropy in bits of a window, by class of the candidate (the most possible: 4, 4.32, 4.32 and 3.32).
LIMITS = {"entropy_hex": 3.0, "entropy_mixed": 3.7, "entropy_letters": 4.0, "entropy_digits": 3.1}
#: Candidates that are no secrets, whatever their entropy: ids of the common 8-4-4-4-12 form, and words
#: joined by signs, paths and names, whose parts are all words or short numbers.
COMMON_ID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
JOINING = "[+/_=-]+"
WORD = "^([A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4})$"
#: Placeholders are cut out of a candidate; windows are looked for in the parts between them.
PLACEHOLDER = "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Dd][Uu][Mm][Mm][Yy]|[Xx]{8}|0{8}|123456789|abcdefgh|ABCDEFGH"
_SLACK = 1e-9


#: Hits whose places are worked out together.
TOGETHER = 512


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Spans of a pattern's matches, with their strings: what lies between the matches gives the
    places, so the matches need not be looked for again. Places are added up within `TOGETHER` hits
    first and then over these, so no long array is copied for each hit."""

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        stop = start + F.char_length(pair["hit"])
        one = F.struct(start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"), pair["hit"].alias("hit"))
        kept = F.lit(True)
        if kind == 0:
            kept = F.char_length(F.regexp_extract(pair["hit"], pattern, 2)) >= ASSIGN_LEAST
        return F.struct(stop.alias("at"), F.when(kept, F.concat(state["spans"], F.array(one))).otherwise(state["spans"]).alias("spans"))

    def parts(pairs: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
        whole = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / TOGETHER).cast("int"))
        return F.transform(whole, lambda k: F.aggregate(F.slice(pairs, k * TOGETHER + 1, F.lit(TOGETHER)), begin, step))

    def placed(parts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            parts, begin, lambda s, p: F.struct((s["at"] + p["at"]).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")), lambda s: s["starts"]
        )

        def moved(part: Column) -> Column:
            def by(x: Column) -> Column:
                return F.struct((x["start"] + part["start"]).alias("start"), (x["stop"] + part["start"]).alias("stop"), x["kind"].alias("kind"), x["hit"].alias("hit"))

            return F.transform(part["part"]["spans"], by)

        return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), starts.alias("start")), moved))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = _let(hits, lambda hits: F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit")))
    return _let(pairs, lambda pairs: F.when(F.size(pairs) > 0, _let(parts(pairs), placed)).otherwise(F.array().cast(_SPANS)))


_SPANS = "array<struct<start:int,stop:int,kind:int,hit:string>>"


def _term(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(run: Column) -> Column:
    """The highest entropy of a window of `run`, by counts that change with each step. The state holds
    the window, so a step costs the window, whatever the run's length. 0 for runs under a window."""

    def count(part: Column, ch: Column) -> Column:
        return F.char_length(part) - F.char_length(F.replace(part, ch, F.lit("")))

    def step(state: Column, came: Column) -> Column:
        full = F.char_length(state["window"]) == WINDOW
        went = F.when(full, F.substr(state["window"], F.lit(1), F.lit(1))).otherwise(F.lit(""))
        stays = F.when(full, F.substr(state["window"], F.lit(2), F.lit(WINDOW - 1))).otherwise(state["window"])
        out, into = count(stays, went), count(stays, came)
        gone = F.when(full, _term(out) - _term(out + 1)).otherwise(F.lit(0.0))
        s = state["s"] + gone + _term(into + 1) - _term(into)
        # In one step at most one of the two terms is of a character that both leave and enter; its
        # count among those that stay is the same before and after, so the order does not matter.
        least = F.when(F.char_length(stays) == WINDOW - 1, F.least(state["least"], s)).otherwise(state["least"])
        return F.struct(F.concat(stays, came).alias("window"), s.alias("s"), least.alias("least"))

    begin = F.struct(F.lit("").alias("window"), F.lit(0.0).alias("s"), F.lit(1e9).alias("least"))
    least = F.aggregate(F.split(run, ""), begin, step, lambda state: state["least"])
    return F.greatest(F.lit(0.0), F.log2(F.lit(float(WINDOW))) - least / WINDOW)


def _class(run: Column) -> Column:
    """The character class that a candidate's limit depends on, as a place in KINDS; NULL: signs only."""
    digit, letter = run.rlike("[0-9]"), run.rlike("[A-Za-z]")
    both = F.when(run.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), F.lit(3)).otherwise(F.lit(4))
    return F.when(digit & letter, both).when(letter, F.lit(5)).when(digit, F.lit(6))


def _is_secret(run: Column) -> Column:
    limit = F.element_at(F.array(*(F.lit(x) for x in LIMITS.values())), _class(run) - 2)
    parts = F.filter(F.split(run, JOINING), lambda x: x != "")
    allowed = run.rlike(COMMON_ID) | F.forall(parts, lambda x: x.rlike(WORD))
    between = F.filter(F.split(run, PLACEHOLDER), lambda x: F.char_length(x) >= WINDOW)
    high = _let(limit, lambda limit: F.exists(between, lambda x: window_entropy(x) >= limit - _SLACK))
    return F.coalesce(_class(run).isNotNull() & ~allowed & high, F.lit(False))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, spans (array of start, stop, kind; code points, stop exclusive; by start, then kind)
    and, on request, the text. `kind` is a place in KINDS; a window span that lies in a pattern's
    span adds nothing and is left out."""
    return with_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "text").select(
        "doc_id", *(["text"] if keep_text else []), "spans"
    )


def with_spans(rows: DataFrame, text_col: str, spans_col: str = "spans") -> DataFrame:
    """`rows` with a column of the spans found in a text column."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(_SPANS)

    def where(mark: Column, pattern: str, kind: int) -> Column:
        return F.when(mark, _found(text, pattern, kind)).otherwise(none)

    runs, shaped = "__runs", "__shaped"
    while runs in rows.columns or shaped in rows.columns:
        runs, shaped = runs + "_", shaped + "_"
    rows = rows.withColumn(
        shaped,
        F.concat(
            where(text.rlike(ASSIGN), ASSIGN, 0),
            where(F.contains(text, F.lit("AKIA")), ACCESS, 1),
            where(text.rlike(HEX), HEX, 2),
        ),
    ).withColumn(runs, where(text.rlike(CANDIDATE), CANDIDATE, 3))
    secret = F.filter(F.col(runs), lambda x: _is_secret(x["hit"]))
    more = F.transform(
        F.filter(secret, lambda x: ~F.exists(F.col(shaped), lambda y: (y["start"] <= x["start"]) & (x["stop"] <= y["stop"]))),
        lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), _class(x["hit"]).alias("kind")),
    )
    base = F.transform(F.col(shaped), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind")))
    by_place = F.array_sort(F.concat(base, more), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]))
    return rows.withColumn(spans_col, by_place).drop(shaped, runs)


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["stop"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: Column, mask: str = "<secret>") -> Column:
    """The text with every span replaced; spans that overlap are replaced as one."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, x: Column) -> Column:
        apart = x["start"] >= state["at"]
        head = F.substr(text, state["at"] + 1, x["start"] - state["at"])
        more = F.when(apart, F.concat(state["parts"], F.array(head, F.lit(mask)))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], x["stop"]).alias("at"), more.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substr(text, state["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, finish)).otherwise(text)
