"""Canonical layer: one row per ``global_order_id`` with standardised
status, money, geography, business flags and a data-quality roll-up.

Only :func:`dedupe_latest` moves rows between tasks (a window shuffled on
the order id).  Everything after it is narrow column work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    canonical_status,
    clean_upper,
    invalid_country,
    invalid_currency,
    round_money,
    strip,
)
from ..functions.status import CANCELLED_STATUSES, REFUND_STATUSES
from ..sources.schema import UNIFIED_COLUMNS


def latest_first_order(df_columns=UNIFIED_COLUMNS) -> list[Column]:
    """Sort order of the dedupe window: the documented keys (latest
    update/processing/creation time, then latest ingestion, NULLs last),
    then every other unified column.  The extra keys make the order total
    over visible values, so the surviving row does not depend on how the
    input was partitioned; two rows that still tie are identical in every
    column, so either one gives the same output."""
    c = F.col
    keys = [
        F.coalesce(c("order_updated_at"), c("order_processed_at"), c("order_created_at")).desc_nulls_last(),
        c("ingested_at").desc_nulls_last(),
    ]
    rest = [n for n in df_columns if n not in ("global_order_id", "ingested_at")]
    return keys + [c(n).desc_nulls_last() for n in rest]


_OWN_KEY = "__null_id_row"


def dedupe_latest(df: DataFrame, keep_null_ids: bool = False) -> DataFrame:
    """Latest row per ``global_order_id``, with its ``rn`` (always 1).

    All rows whose id is NULL share one window partition, so only one of
    them survives (the reference behaviour).  The filter on ``rn = 1`` lets
    Catalyst put a ``WindowGroupLimit`` on the map side of the shuffle: each
    task sends at most one row per order, so a hot order id or the NULL
    group costs one row per task, not one task full of rows.

    ``keep_null_ids=True`` keeps every NULL-id row instead: each gets a window
    key of its own (a row number, NULL for rows with an id), so the rows are read
    once, spread evenly over tasks, and none competes with another; their
    ``rn`` is NULL, which the fact's guard accepts.

    The window is partitioned by ``(xxhash64(id), id)``: the same groups as
    ``id`` alone (NULL ids included: they share one hash), but the sort
    before the window then leads with a 64-bit hash instead of ids that all
    start with the same "amazon:"/"shopify:" bytes, so Spark's 8-byte sort
    prefix separates rows and the full comparator is rarely needed (a third
    faster on sf0.1).
    """
    gid = F.col("global_order_id")
    key = [F.xxhash64(gid), gid]
    if keep_null_ids:
        df = df.withColumn(_OWN_KEY, F.when(gid.isNull(), F.monotonically_increasing_id()))
        key.append(F.col(_OWN_KEY))
    w = Window.partitionBy(*key).orderBy(*latest_first_order([c for c in df.columns if c != _OWN_KEY]))
    ranked = df.withColumn("rn", F.row_number().over(w).cast("bigint")).where(F.col("rn") == 1)
    if keep_null_ids:
        ranked = ranked.withColumn("rn", F.when(gid.isNotNull(), F.col("rn"))).drop(_OWN_KEY)
    return ranked


def null_id_report(stacked: DataFrame) -> DataFrame:
    """One row: rows stacked, those with a NULL ``global_order_id``, and how many
    of them :func:`dedupe_latest` drops (by default one of them survives)."""
    null_ids = F.count_if(F.col("global_order_id").isNull())
    return stacked.agg(F.count("*").alias("stacked_rows"), null_ids.alias("null_id_rows"),
                       F.greatest(null_ids - 1, F.lit(0).cast("bigint")).alias("null_id_rows_dropped"))


def add_customer_key(df: DataFrame) -> DataFrame:
    """``global_customer_id = source_system:customer_id``; NULL without a customer."""
    gcid = F.when(F.col("customer_id").isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.col("source_system"), F.lit(":"), F.col("customer_id").cast("string")))
    return df.withColumn("global_customer_id", gcid)


def standardize_status(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "order_status_canon": canonical_status(c("order_status")),
        "payment_status": F.when(c("financial_status").isNull(), F.lit(None).cast("string"))
        .otherwise(F.upper(strip(c("financial_status")))),
        # The marketplace's fulfilment state is its order status.
        "fulfillment_status_canon": F.when(c("source_system") == "amazon", F.upper(strip(c("order_status"))))
        .when(c("fulfillment_status").isNotNull(), F.upper(strip(c("fulfillment_status"))))
        .otherwise(F.lit(None).cast("string")),
    })


MONEY_COLUMNS = ("order_total", "subtotal_price", "total_discounts", "total_tax")


def standardize_money(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{m}_num": round_money(F.col(m)) for m in MONEY_COLUMNS})


def standardize_geo(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "currency_canon": clean_upper("currency"),
        "shipping_country_canon": clean_upper("shipping_country"),
    })


def business_flags(df: DataFrame) -> DataFrame:
    """Three-valued on purpose: NULL status gives NULL flags; a storefront row
    with NULL ``is_test`` gives NULL ``is_test_order``."""
    c = F.col
    status = c("order_status_canon")
    return df.withColumns({
        "is_test_order": (c("source_system") == "shopify") & (c("is_test") == F.lit(True)),
        "is_cancelled": status.isin(*CANCELLED_STATUSES),
        "is_refund_or_return": status.isin(*REFUND_STATUSES),
    })


CANONICAL_DQ_FLAGS = (
    "dq_global_order_id_is_null", "dq_order_id_is_null", "dq_order_created_at_is_null",
    "dq_order_total_is_null", "dq_order_total_is_negative", "dq_currency_invalid_format",
    "dq_shipping_country_invalid_format",
)


def dq_rollup(df: DataFrame) -> DataFrame:
    """Seven row-level checks on canonical columns and their OR."""
    c = F.col
    total = c("order_total_num")
    checks = {
        "dq_global_order_id_is_null": c("global_order_id").isNull(),
        "dq_order_id_is_null": c("order_id").isNull(),
        "dq_order_created_at_is_null": c("order_created_at").isNull(),
        "dq_order_total_is_null": total.isNull(),
        "dq_order_total_is_negative": total.isNotNull() & (total < 0),
        "dq_currency_invalid_format": invalid_currency(c("currency_canon")),
        "dq_shipping_country_invalid_format": invalid_country(c("shipping_country_canon")),
    }
    has_issue = None
    for e in checks.values():
        has_issue = e if has_issue is None else (has_issue | e)
    return df.withColumns({**checks, "dq_has_issue": has_issue})


def event_time(df: DataFrame) -> DataFrame:
    ts = F.coalesce(F.col("order_created_at"), F.col("order_processed_at"), F.col("order_updated_at"))
    return df.withColumns({"order_event_ts": ts, "order_event_date": F.to_date(ts)})


def standardize(rows: DataFrame) -> DataFrame:
    """P10-P16 composed: the 23 derived columns, row by row."""
    return (rows.transform(add_customer_key)
            .transform(standardize_status)
            .transform(standardize_money)
            .transform(standardize_geo)
            .transform(business_flags)
            .transform(dq_rollup)
            .transform(event_time))


def canonical_orders(stacked: DataFrame, keep_null_ids: bool = False) -> DataFrame:
    """P09-P16 composed: 25 unified columns + ``rn`` + 23 derived columns."""
    return standardize(dedupe_latest(stacked, keep_null_ids=keep_null_ids))
