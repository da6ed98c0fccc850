"""Date helpers: file-name dates, as-of dates and day differences."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first ``YYYY-MM-DD`` in a file name, and the oldest
# business date that is not flagged as too old.
FILE_DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
MIN_VALID_DATE = _dt.date(2010, 1, 1)


def source_file_date(path: Column) -> Column:
    """First ``YYYY-MM-DD`` in the name as a DATE; NULL if absent or invalid.

    ``regexp_extract`` yields '' on no match and ``try_cast('' as date)`` is
    NULL, so both "no date" and "impossible date" become NULL.
    """
    return F.regexp_extract(path, FILE_DATE_PATTERN, 0).try_cast("date")


def as_of_col(as_of: _dt.date | str | None) -> Column:
    """The "today" used by future-date flags and recency; ``current_date()``
    when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def day_diff(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later`` as BIGINT."""
    return F.datediff(later, earlier).cast("bigint")
