"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from .dates import MIN_VALID_DATE, as_of_col, day_diff, source_file_date
from .money import NUMERIC, count_true, round_money, safe_ratio, to_numeric
from .status import (
    ALLOWED_CHANNELS,
    ALLOWED_STATUSES,
    canonical_status,
    map_fulfillment_channel,
    map_status,
)
from .text import (
    WHITESPACE,
    clean,
    clean_upper,
    invalid_country,
    invalid_currency,
    strip,
)

__all__ = [
    "ALLOWED_CHANNELS", "ALLOWED_STATUSES", "MIN_VALID_DATE", "NUMERIC",
    "WHITESPACE", "as_of_col", "canonical_status", "clean", "clean_upper",
    "count_true", "day_diff", "invalid_country", "invalid_currency",
    "map_fulfillment_channel", "map_status", "round_money",
    "safe_ratio", "source_file_date", "strip", "to_numeric",
]
