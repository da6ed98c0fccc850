"""Money typing, rounding and NULL-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The warehouse NUMERIC type (38 digits, 9 after the point)
# and the number of places money is rounded to in the canonical layer.
NUMERIC = "decimal(38,9)"
MONEY_PLACES = 2


def to_numeric(c: Column) -> Column:
    """FLOAT64 -> NUMERIC (half-up at the 9th place)."""
    return c.cast(NUMERIC)


def round_money(c: Column) -> Column:
    """Round half away from zero to 2 places, kept as NUMERIC."""
    return F.round(c.cast(NUMERIC), MONEY_PLACES).cast(NUMERIC)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` that is NULL when ``den`` is 0 or NULL."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def count_true(cond: Column) -> Column:
    """Rows where ``cond`` is TRUE (NULL counts as not true)."""
    return F.count_if(cond)
