"""Order-dependent operators that do not gather a key into one task.

A window partitioned by a user or a symbol puts all rows of that key into one task, and one key may
hold a third of the data. So keys with many rows are cut into *slices* of their order, and each slice
receives the few rows just before it from the slices to its left. The cuts of a key are quantiles of
a sample of its rows that depends on nothing but the rows' content: wherever and however often the
plan computes them, they come out the same. So nothing has to be counted or stored while a frame is
built, and a lost task changes no slice. The sample decides how even the slices are, never a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import percent

ROWS_PER_SLICE = 5_000_000
#: Sampled rows per cut of a key, about, and the most cuts of a key.
SAMPLED, MOST_CUTS = 32, 4096
_GRAINS = 1 << 40


def _same(keys: Sequence[str], left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]


def cuts_of(df: DataFrame, keys: Sequence[str], by: str, rows_per_slice: int, slices: int | None = None) -> DataFrame:
    """keys, `__cuts`: for each key of more than `rows_per_slice` rows the ordered values of `by` at which
    its slices end (`slices` of them if given, else as its rows demand)."""
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_slice)
    wanted = F.lit(slices - 1) if slices else F.least(F.ceil(F.col("__n") / rows_per_slice), F.lit(MOST_CUTS))
    many = many.withColumn("__wanted", wanted.cast("int")).where("__wanted > 0")
    # A row is sampled by its content: about SAMPLED rows for each cut.
    grain = F.pmod(F.xxhash64(*keys, by), F.lit(_GRAINS))
    share = F.col("m.__wanted") * F.lit(float(SAMPLED)) / F.col("m.__n")
    rows = df.select(*keys, by).where(F.col(by).isNotNull()).withColumn("__grain", grain)
    sample = rows.alias("r").join(many.alias("m"), [*_same(keys, "r", "m"), F.col("r.__grain") < share * F.lit(float(_GRAINS))])
    seen = sample.groupBy(*[F.col(f"r.`{k}`") for k in keys], "m.__wanted").agg(F.sort_array(F.collect_set(f"r.`{by}`")).alias("__seen"))
    size, n = F.size("__seen"), F.col("__wanted")
    picks = F.transform(F.sequence(F.lit(1), n), lambda k: F.try_element_at("__seen", F.greatest(F.lit(1), (k * size / (n + 1)).cast("int"))))
    return seen.where(size > 0).select(*keys, F.array_distinct(picks).alias("__cuts"))


def with_slices(df: DataFrame, keys: Sequence[str], by: str, cuts: DataFrame) -> DataFrame:
    """`df` with `__slice`: how many cuts of its key lie below a row, NULL for keys without cuts. The cuts
    are few rows, so their side is broadcast where its size is known to be small."""
    place = F.size(F.filter("c.__cuts", lambda x: F.coalesce(x < F.col(f"r.`{by}`"), F.lit(False))))
    return df.alias("r").join(cuts.alias("c"), _same(keys, "r", "c"), "left").select("r.*", F.when(F.col("c.__cuts").isNotNull(), place).alias("__slice"))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int,
    name: str = "previous",
    slices: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add `name`: the last `n` values before the row in its key, oldest first.

    `order` must be total inside a key; slices are cut by its first column, so rows that are equal in
    it stay in one slice. Keys of up to `rows_per_slice` rows are not sliced; with `slices` every key is
    cut into about so many. The result is lazy: building it runs no job.
    """
    keys, order = list(keys), list(order)
    if slices is not None:
        rows_per_slice = 0
    cut = with_slices(df, keys, order[0], cuts_of(df, keys, order[0], rows_per_slice, slices))
    here = [*keys, "__slice"]
    inside = Window.partitionBy(*here).orderBy(*order).rowsBetween(-n, -1)
    back = Window.partitionBy(*here).orderBy(*[F.desc(o) for o in order])
    boxed = F.struct(F.col(value).alias("v"))  # a struct keeps NULL values in the collected lists
    # The last rows of each slice of a sliced key: n for each slice.
    tails = (
        cut.where(F.col("__slice").isNotNull())
        .select(*here, *[o for o in order if o not in keys], boxed.alias("__v"))
        .withColumn("__rank", F.row_number().over(back))
        .where(F.col("__rank") <= n)
        .groupBy(*here)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("__rank")).alias("r"), "__v"))).alias("t"))
        .select(*here, F.transform("t", lambda x: x["__v"]).alias("__tail"))
    )
    # A tail holds at least one row, so n slices to the left are enough; slices without rows of a
    # key have no tail, and the next one takes what lies before them.
    left = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(-n, -1)
    carry = tails.withColumn("__carry", F.flatten(F.collect_list("__tail").over(left))).drop("__tail")

    rows = cut.withColumn("__in", F.collect_list(boxed).over(inside))
    joined = rows.alias("r").join(carry.alias("k"), _same(here, "r", "k"), "left")
    both = F.when(F.col("k.__carry").isNull(), F.col("r.__in")).otherwise(F.concat(F.col("k.__carry"), F.col("r.__in")))
    start = F.greatest(F.size(both) - F.lit(n - 1), F.lit(1))
    last = F.slice(both, start, F.lit(n))
    return joined.select(*[F.col(f"r.`{x}`") for x in df.columns], F.transform(last, lambda x: x["v"]).alias(name))


def price_changes(
    prices: DataFrame,
    key: str = "symbol",
    order: Sequence[str] = ("timestamp",),
    price: str = "price",
    slices: int | None = None,
) -> DataFrame:
    """Previous price of the same symbol and the change in percent."""
    seen = with_previous(prices, [key], order, price, 1, "__before", slices)
    prev = F.try_element_at("__before", F.lit(1))
    return (
        seen.withColumn("prev_price", prev)
        .withColumn(
            "price_change_pct",
            percent(F.col(price) - F.col("prev_price"), F.col("prev_price"), digits=None),
        )
        .drop("__before")
    )


def behavior_zscore(
    tx: DataFrame,
    order: Sequence[str] = ("event_ts", "transaction_id"),
    user: str = "sender_user_id",
    amount: str = "usd_amount",
    n: int = 20,
    min_history: int = 2,
    slices: int | None = None,
) -> DataFrame:
    """How far an amount lies from the sender's last `n` amounts, in sample deviations.

    NULL while the sender has fewer than `min_history` earlier amounts or they do not vary.
    """
    seen = with_previous(tx, [user], order, amount, n, "__before", slices)
    known = F.filter("__before", lambda x: x.isNotNull())
    size = F.size(known)

    def total(values: Column, f) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + f(x))

    mean = F.try_divide(total(known, lambda x: x), size)
    square = total(known, lambda x: (x - F.col("history_mean")) * (x - F.col("history_mean")))
    deviation = F.sqrt(F.try_divide(square, size - 1))
    enough = F.col("history_count") >= min_history
    return (
        seen.withColumn("history_count", size.cast("bigint"))
        .withColumn("history_mean", mean)
        .withColumn("history_stddev", F.when(enough, deviation))
        .withColumn(
            "amount_zscore",
            F.when(
                F.col("history_stddev") > 0,
                (F.col(amount) - F.col("history_mean")) / F.col("history_stddev"),
            ),
        )
        .drop("__before")
    )


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], slices: int | None = None, values_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """(column, q0, q1, ...): the smallest value whose rank reaches each share of the rows.

    Values are counted first, so equal values cost one row however often they occur. The distinct
    values of a column are cut into ordered slices; the rows in each are added up, which tells the
    slice that holds a wanted rank, and only the values of those slices are ranked one by one. Lazy.
    """
    cells = [F.struct(F.lit(x).alias("column"), F.col(x).cast("double").alias("value")) for x in cols]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cuts = cuts_of(counts, ["column"], "value", values_per_slice if slices is None else 0, slices)
    cut = with_slices(counts, ["column"], "value", cuts).withColumn("__slice", F.coalesce("__slice", F.lit(0)))
    by_column = Window.partitionBy("column")  # one row per slice
    before = by_column.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    shares = F.array(*[F.lit(float(p)) for p in probabilities])
    totals = (
        cut.groupBy("column", "__slice")
        .agg(F.sum("n").alias("t"))
        .select(
            "column",
            "__slice",
            "t",
            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("skipped"),
            F.transform(shares, lambda p: F.greatest(F.ceil(F.sum("t").over(by_column) * p), F.lit(1))).alias("targets"),
        )
        .where(F.exists("targets", lambda x: (F.col("skipped") < x) & (x <= F.col("skipped") + F.col("t"))))
    )
    inside = Window.partitionBy("column", "__slice").orderBy("value")
    ranked = cut.join(totals, ["column", "__slice"]).withColumn("upto", F.col("skipped") + F.sum("n").over(inside))

    def at(i: int) -> Column:
        target = F.col("targets")[i]
        return F.max(F.when((F.col("upto") >= target) & (F.col("upto") - F.col("n") < target), F.col("value")))

    return ranked.groupBy("column").agg(*[at(i).alias(f"q{i}") for i in range(len(probabilities))])
