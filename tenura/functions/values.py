"""Number and text expressions that keep NULL apart from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenura import fixed_values as fv


def money(c: Column) -> Column:
    """Two decimals, halves to even, on doubles."""
    return F.rint(c.cast("double") * 100) / 100


def at_least(c: Column, low: float) -> Column:
    """Raise values below the bound to it; unlike greatest(), NULL stays NULL."""
    return F.when(c < low, F.lit(low)).otherwise(c)


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def non_negative(c: Column) -> Column:
    """At least zero, and zero for NULL."""
    return F.coalesce(at_least(c, 0), F.lit(0))


def truthy(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """NULL instead of a division error when the whole is zero."""
    return part / F.nullif(whole, F.lit(0))


def percent_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def strip(c: Column) -> Column:
    """Drop blanks of every kind at both ends; a plain trim() would leave tabs.

    Most cells start and end with a printable ASCII character and are done with that look;
    only the others are searched for the rarer blanks.
    """
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)
    clean = first.between("!", "~") & last.between("!", "~")
    return F.when(clean, c).otherwise(F.trim(c, F.lit(fv.BLANKS)))


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*fv.MISSING_TOKENS), c)


def padded_id(prefix: str, key: Column, width: int = 9) -> Column:
    """Prefix plus the zero-padded number; longer numbers are kept whole."""
    text = key.cast("string")
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    return F.concat(F.lit(prefix), padded)
