"""Data-quality flags, required fields, partition columns, fills and casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow import fixed
from ledgerflow.functions.cleaning import coerce
from ledgerflow.functions.numbers import percent
from ledgerflow.operators.ordered import exact_quantiles


@dataclass(frozen=True)
class QualityRules:
    min_amount: float = fixed.MIN_AMOUNT
    max_amount: float = fixed.MAX_AMOUNT
    countries: tuple[str, ...] = fixed.QUALITY_COUNTRIES
    symbols: tuple[str, ...] = fixed.QUALITY_SYMBOLS
    statuses: tuple[str, ...] = fixed.STATUS_VALUES
    risk_levels: tuple[str, ...] = fixed.RISK_LEVELS
    high_quality: float = fixed.HIGH_QUALITY_SCORE


@dataclass(frozen=True)
class EventPaths:
    """Where the checked values sit; the default is the nested event."""

    transaction_id: str = "transaction_id"
    usd: str = "transfer.usd_equivalent"
    sender_country: str = "sender.country"
    receiver_country: str = "receiver.country"
    symbol: str = "transfer.crypto_symbol"
    status: str = "status"
    risk_level: str = "compliance.risk_level"


FLAT_PATHS = EventPaths(
    usd="usd_amount",
    sender_country="sender_country",
    receiver_country="receiver_country",
    symbol="crypto_currency",
    risk_level="risk_level",
)

DQ_FLAGS = (
    "dq_transaction_id_valid",
    "dq_amount_valid",
    "dq_country_valid",
    "dq_currency_valid",
    "dq_status_valid",
    "dq_risk_level_valid",
)


def _one_of(c: Column, values: Sequence[str]) -> Column:
    """Membership in a constant list; shorter generated code than IN, as it is a loop."""
    return F.array_contains(F.array(*[F.lit(v) for v in values]), c)


def quality_flags(
    df: DataFrame, rules: QualityRules = QualityRules(), paths: EventPaths = EventPaths()
) -> DataFrame:
    """Add six checks, their share and `is_high_quality`; no row is dropped, NULL fails."""
    usd = F.col(paths.usd)
    countries = (F.col(paths.sender_country), F.col(paths.receiver_country))
    checks = (
        F.length(F.col(paths.transaction_id)) > 0,
        usd.between(rules.min_amount, rules.max_amount),
        reduce(and_, (_one_of(c, rules.countries) for c in countries)),
        _one_of(F.col(paths.symbol), rules.symbols),
        _one_of(F.col(paths.status), rules.statuses),
        _one_of(F.col(paths.risk_level), rules.risk_levels),
    )
    flags = {name: F.coalesce(c, F.lit(False)) for name, c in zip(DQ_FLAGS, checks, strict=True)}
    # All in one step: between two steps the event's structs would be built for every row.
    score = reduce(add, (x.cast("int") for x in flags.values())) / F.lit(6.0)
    return df.withColumns(flags | {"data_quality_score": score, "is_high_quality": score >= rules.high_quality})


def quality_summary(flagged: DataFrame) -> DataFrame:
    """One row per score: rows, and how many pass each check."""
    passes = [F.count_if(F.col(name)).alias(name.replace("_valid", "_passed")) for name in DQ_FLAGS]
    return flagged.groupBy("data_quality_score", "is_high_quality").agg(
        F.count(F.lit(1)).alias("row_count"), *passes
    )


def required_present(fields: Sequence[str] = fixed.REQUIRED_FIELDS) -> Column:
    return reduce(and_, (F.col(f).isNotNull() for f in fields))


def split_required(
    df: DataFrame, fields: Sequence[str] = fixed.REQUIRED_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rejected rows with the names of their missing fields)."""
    ok = required_present(fields)
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), f) for f in fields]))
    return df.where(ok), df.where(~ok).withColumn("missing_fields", missing)


def add_partitions(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Calendar columns used as folder names."""
    t = F.col(ts)
    return df.withColumns(
        {
            "date_partition": F.date_format(t, "yyyy-MM-dd"),
            "hour_partition": F.hour(t),
            "year": F.year(t),
            "month": F.month(t),
            "day": F.dayofmonth(t),
            "hour": F.hour(t),
            "date": F.to_date(t),
        }
    )


def flatten_all(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every leaf of every struct as its own column, named by its path."""

    def leaves(schema: StructType, path: tuple[str, ...] = ()):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*leaves(df.schema))


# Largest number of each narrow integer type.
_LARGEST = {"tinyint": 2**7 - 1, "smallint": 2**15 - 1, "int": 2**31 - 1}


def narrow(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to the narrow storage types given; unreadable or too large values become NULL.

    Integers are compared with the range first: a failed cast costs far more than a comparison.
    """
    given = dict(df.dtypes)

    def cast(name: str, to: str) -> Column:
        x, most = F.col(name), _LARGEST.get(to)
        if most is None or given[name] not in (*_LARGEST, "bigint"):
            return coerce(x, to)
        return F.when(x.between(-most - 1, most), x).cast(to)

    return df.withColumns({c: cast(c, t) for c, t in types.items() if c in given})


def narrow_rejects(df: DataFrame, types: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """What `narrow` cannot hold: the `keep` columns, the column's name and its value as text."""
    given = [c for c in types if c in df.columns]
    cast = narrow(df.withColumns({f"__{c}": F.col(c) for c in given}), types)
    lost = [
        F.when(F.col(c).isNull() & F.col(f"__{c}").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"__{c}").cast("string").alias("value")))
        for c in given
    ]
    return cast.select(*keep, F.explode(F.array_compact(F.array(*lost))).alias("__lost")).select(*keep, "__lost.*")


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(cols))


def valid_dates(df: DataFrame, as_of: Column, date_col: str = "date") -> DataFrame:
    """Rows whose date is present and not in the future."""
    return df.where(F.col(date_col) <= as_of)


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_percent) for all columns in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot(
        ids=["__rows"],
        values=[f"`{c}`" for c in df.columns],
        variableColumnName="column_name",
        valueColumnName="null_count",
    ).select(
        "column_name",
        "null_count",
        F.coalesce(percent(F.col("null_count"), F.col("__rows")), F.lit(0.0)).alias("null_percent"),
    )


STATISTICS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def numeric_summary(
    df: DataFrame, cols: Sequence[str], accuracy: int = 10_000, exact: bool = False
) -> DataFrame:
    """count, mean, stddev, min, quartiles and max of each column, one row per statistic.

    Quartiles are approximate, as in `DataFrame.summary`: they come from a mergeable sketch of
    bounded size and are off by at most about 1/accuracy of the rows in rank. With `exact`
    they are ranked over all values, at the price of a shuffle of the distinct values.
    """
    shares = [0.25, 0.5, 0.75]

    def named(col: str, quartiles: list[Column]) -> Column:
        x = F.col(col)
        cells = [F.count(x), F.avg(x), F.stddev(x), F.min(x), *quartiles, F.max(x)]
        return F.array(*[v.cast("double") for v in cells]).alias(col)

    def sketch(col: str) -> list[Column]:
        found = F.percentile_approx(F.col(col), shares, accuracy)
        return [found[i] for i in range(3)]

    def ranked(col: str) -> list[Column]:
        return [F.col(f"__quartiles.`{col}`.q{i}") for i in range(3)]

    if exact:  # one row, asked for once
        found = exact_quantiles(df, cols, shares)
        wide = [F.max(F.when(F.col("column") == x, F.struct("q0", "q1", "q2"))).alias(x) for x in cols]
        quartiles = found.agg(*wide).select(F.struct(*[f"`{x}`" for x in cols])).scalar()
        cells = [named(x, [F.lit(None).cast("double")] * 3) for x in cols]
        one = df.agg(*cells).withColumn("__quartiles", quartiles)
        one = one.select(*[F.concat(F.slice(x, 1, 4), F.array(*ranked(x)), F.slice(x, 8, 1)).alias(x) for x in cols])
    else:
        one = df.agg(*[named(x, sketch(x)) for x in cols])
    rows = F.arrays_zip(F.array(*[F.lit(s) for s in STATISTICS]).alias("summary"), *cols)
    return one.select(F.inline(rows))
