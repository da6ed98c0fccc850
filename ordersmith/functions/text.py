"""String cleaning and format checks, as Catalyst column expressions.

Spark's one-argument ``trim`` strips only the space character, while the
pipeline's contract is "strip all whitespace".  Every trim in the code
base therefore goes through :func:`clean` with one explicit character set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters stripped by ``clean``.
# U+0009 to U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000 to U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Format rules for ISO currency and country codes.  ``\z`` is
# the end of the text; Java's ``$`` would also match before a final newline.
CURRENCY_PATTERN = r"^[A-Z]{3}\z"
COUNTRY_PATTERN = r"^[A-Z]{2}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim all Unicode whitespace from both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean(c: Column | str) -> Column:
    """Trim all whitespace, then turn the empty string into NULL."""
    return F.nullif(strip(c), F.lit(""))


def clean_upper(c: Column | str) -> Column:
    """``clean`` then upper-case (currencies, countries, statuses)."""
    return F.upper(clean(c))


def invalid_format(c: Column | str, pattern: str) -> Column:
    """True when a present value does not match ``pattern``; FALSE for NULL."""
    c = _col(c)
    return c.isNotNull() & ~c.rlike(pattern)


def invalid_currency(c: Column | str) -> Column:
    return invalid_format(c, CURRENCY_PATTERN)


def invalid_country(c: Column | str) -> Column:
    return invalid_format(c, COUNTRY_PATTERN)
