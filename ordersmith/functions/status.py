"""Status and channel vocabularies as column expressions.

Each vocabulary is a literal map looked up once per row (``try_element_at``
gives NULL for an unknown word, which then falls through to the
upper-cased input).  A ``CASE`` chain would evaluate the normalised word in
every branch, and Spark does not share sub-expressions across conditional
branches, so the map form keeps the generated code small.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The canonical order statuses and their accepted spellings.
STATUS_SYNONYMS = {
    "CANCELLED": ("cancelled", "canceled"),
    "COMPLETED": ("complete", "completed"),
    "PENDING": ("pending",),
    "REFUNDED": ("refunded",),
    "RETURNED": ("returned",),
    "SHIPPED": ("shipped",),
    "UNSHIPPED": ("unshipped",),
}
ALLOWED_STATUSES = tuple(STATUS_SYNONYMS)

# Marketplace fulfilment channel codes and canonical names.
CHANNELS = {"AFN": "AMAZON", "MFN": "MERCHANT"}
ALLOWED_CHANNELS = ("AMAZON", "MERCHANT")

# Statuses that take an order out of revenue.
CANCELLED_STATUSES = ("CANCELLED",)
REFUND_STATUSES = ("REFUNDED", "RETURNED")


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def _lookup(pairs: dict[str, str], key: Column, fallback: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(pairs), key), fallback)


def map_status(cleaned: Column) -> Column:
    """Marketplace status from the *cleaned* value (``clean(raw)``): synonyms
    matched in lower case -> canonical word; anything else upper-cased;
    NULL stays NULL."""
    lower_to_canon = {s: canon for canon, spellings in STATUS_SYNONYMS.items() for s in spellings}
    return _lookup(lower_to_canon, F.lower(cleaned), F.upper(cleaned))


def canonical_status(status: Column) -> Column:
    """Canonical-layer status: the same vocabulary matched on the upper-cased,
    trimmed value; only a NULL input gives NULL (blank stays blank)."""
    upper_to_canon = {s.upper(): canon for canon, spellings in STATUS_SYNONYMS.items() for s in spellings}
    word = F.upper(strip(status))
    return _lookup(upper_to_canon, word, word)


def map_fulfillment_channel(cleaned: Column) -> Column:
    """From the cleaned value: AFN -> AMAZON, MFN -> MERCHANT, else upper-cased."""
    code = F.upper(cleaned)
    return _lookup(CHANNELS, code, code)
