"""Exact sums, averages, shares and number text.

Money and scores arrive as doubles with a known number of decimals. Adding doubles gives a
result that depends on the order of the additions, that is on the partitioning. The helpers
below add whole units (cents, micro-points) as BIGINT instead: exact, order-free, and cheaper
than wide decimals because the running sums stay primitives in the hash aggregate. Units are added
in two parts, millions and the rest, and brought together once per group as a decimal, so no sum
of amounts overflows. An amount that is not a number makes its sum one that is not.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = 2
FEE = 4
SCORE = 6


def units(c: Column, scale: int = MONEY) -> Column:
    """Nearest whole number of 10^-scale units, as BIGINT."""
    return F.floor(c * F.lit(float(10**scale)) + F.lit(0.5))


_MILLION = 1_000_000
#: Amounts from here on leave the range of whole units; their parts are taken as doubles.
_LARGE = 9e14


def _parts(c: Column, scale: int, where: Column | None = None) -> tuple[Column, Column]:
    """Millions of whole units, and the units left."""
    c = F.nanvl(c.cast("double"), F.lit(0.0))
    large = F.abs(c) >= F.lit(_LARGE)
    u = units(c, scale)
    per_million = F.lit(float(10**scale) / _MILLION)
    high = F.when(large, F.floor(c * per_million)).otherwise(F.floor(u / F.lit(float(_MILLION))))
    rest = F.floor((c - high / per_million) * F.lit(float(10**scale)))
    low = F.when(large, rest).otherwise(u - high * _MILLION)
    if where is not None:
        high, low = (F.when(where, x).otherwise(F.lit(0)) for x in (high, low))
    return high, low


def _joined(high: Column, low: Column) -> Column:
    return (high.cast("decimal(31,0)") * F.lit(_MILLION)).cast("decimal(38,0)") + low


def sum_units(c: Column, scale: int = MONEY, where: Column | None = None) -> Column:
    """SUM of whole units as DECIMAL(38,0); NaN amounts count 0 here (see `exact_sum`)."""
    high, low = _parts(c, scale, where)
    return _joined(F.sum(high), F.sum(low))


def sum_state(name: str, c: Column, scale: int = MONEY) -> dict[str, Column]:
    """The sum and number of `c` as aggregates that can be added up later (`merged_state`): the two
    parts of the units, whether an amount is not a number, and how many there are."""
    high, low = _parts(c, scale)
    return {f"{name}_high": F.sum(high), f"{name}_low": F.sum(low), f"{name}_odd": F.max(F.isnan(c)), f"{name}_n": F.count(c)}


def merged_state(name: str) -> dict[str, Column]:
    """Aggregates that bring several states of `name` together."""
    return {x: F.max(x) if x.endswith("_odd") else F.sum(x) for x in (f"{name}_high", f"{name}_low", f"{name}_odd", f"{name}_n")}


def state_sum(name: str, scale: int = MONEY) -> Column:
    """What `exact_sum` gives, from the columns of a state."""
    total = _joined(F.col(f"{name}_high"), F.col(f"{name}_low")).cast("double") / F.lit(float(10**scale))
    return F.when(F.col(f"{name}_odd"), F.lit(float("nan"))).otherwise(total)


def state_avg(name: str, scale: int = MONEY) -> Column:
    """What `exact_avg` gives, from the columns of a state."""
    return F.try_divide(state_sum(name, scale), F.col(f"{name}_n"))


def round_units(c: Column, scale: int = MONEY) -> Column:
    """`c` rounded half up to `scale` decimals, without leaving primitive arithmetic."""
    return units(c, scale) / F.lit(float(10**scale))


def exact_sum(c: Column, scale: int = MONEY, where: Column | None = None) -> Column:
    """SUM over units; with `where`, rows that do not satisfy it add 0. NaN if an amount is NaN."""
    total = sum_units(c, scale, where).cast("double") / F.lit(float(10**scale))
    no_number = F.isnan(c) if where is None else F.isnan(c) & where
    return F.when(F.max(no_number), F.lit(float("nan"))).otherwise(total)


def decimal_sum(c: Column) -> Column:
    """SUM at 8 decimals, for prices and volumes of coins: whole numbers and hundred-millionths are
    added apart, each as BIGINT. A value that is infinite or not a number decides the sum."""
    finite = F.abs(c) < F.lit(float("inf"))
    known = F.when(finite, c)
    whole = F.floor(known)
    rest = F.floor((known - whole) * F.lit(1e8) + F.lit(0.5))
    total = F.sum(whole).cast("decimal(20,0)") + F.sum(rest).cast("decimal(20,0)") * F.lit(Decimal("0.00000001"))
    return F.coalesce(F.sum(F.when(~finite, c)), total.cast("double"))


def decimal_avg(c: Column) -> Column:
    """AVG at 8 decimals; NULL rows are left out, NaN counts and makes the average NaN."""
    return F.try_divide(decimal_sum(c), F.count(c))


def exact_avg(c: Column, scale: int = MONEY) -> Column:
    """AVG over units; NULL rows are left out, an all-NULL group gives NULL."""
    return F.try_divide(exact_sum(c, scale), F.count(c))


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """part / whole * 100, NULL for an empty whole."""
    p = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return p if digits is None else F.round(p, digits)


def whole_units(c: Column) -> Column:
    """Integer part of a non-negative amount."""
    return F.floor(c).cast("bigint")


_STEPS = ((1e12, " trillion"), (1e9, " billion"), (1e6, " million"), (1e3, " thousand"))


def readable_quantity(c: Column) -> Column:
    """Short text of a count or amount, such as `3.92 billion`."""
    text = F.format_string("%.2f", F.round(c.cast("double"), 2))
    for size, word in reversed(_STEPS):
        scaled = F.format_string("%.2f" + word, F.round(c.cast("double") / F.lit(size), 2))
        text = F.when(F.abs(c) >= F.lit(size), scaled).otherwise(text)
    return text


def dollars(c: Column) -> Column:
    """`$` and the whole number of dollars."""
    return F.concat(F.lit("$"), c.cast("bigint").cast("string"))
