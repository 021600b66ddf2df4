"""Standard spellings and tolerant casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow import fixed

# The characters a text strip removes.
_BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space at both ends, tabs and line breaks included.

    Text that starts and ends with a printable ASCII character has none; this common case is
    recognised by two byte comparisons instead of a search in the list of blanks.
    """
    bare = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(bare, c).otherwise(F.btrim(c, F.lit(_BLANKS)))


def lookup(c: Column, table: Mapping[str, object]) -> Column:
    """Value of `c` in a small fixed table, NULL when absent."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), c)


def known_currency(clean: Column) -> Column:
    """A stripped upper-case symbol, or the mark for none."""
    return F.coalesce(clean, F.lit(fixed.UNKNOWN))


def known_country(clean: Column, names: Mapping[str, str] = fixed.COUNTRY_NAMES) -> Column:
    """The code of a stripped upper-case country, or the mark for none."""
    return F.coalesce(lookup(clean, names), clean, F.lit(fixed.UNKNOWN))


def std_currency(c: Column) -> Column:
    return known_currency(strip(F.upper(c)))


def std_country(c: Column, names: Mapping[str, str] = fixed.COUNTRY_NAMES) -> Column:
    return known_country(strip(F.upper(c)), names)


def coerce(c: Column, to: str) -> Column:
    """Cast that turns unreadable values into NULL."""
    return c.try_cast(to)
