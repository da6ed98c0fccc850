"""Staging layer: keep every raw column, add cleaned columns and in-row
data-quality flags.  Bad rows are flagged, never dropped, so each function
is narrow (projections only, no shuffle) and runs in the same stage as the
scan that feeds it."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    ALLOWED_CHANNELS,
    ALLOWED_STATUSES,
    MIN_VALID_DATE,
    as_of_col,
    clean,
    clean_upper,
    invalid_country,
    invalid_currency,
    map_fulfillment_channel,
    map_status,
    source_file_date,
    to_numeric,
)


def _date_checks(ts, d, today):
    return (ts.isNull(),
            ts.isNotNull() & (d > today),
            ts.isNotNull() & (d < F.lit(MIN_VALID_DATE)))


def stage_marketplace(raw: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """12 raw columns + 12 cleaned columns + 20 DQ flags (D01-D20).

    Three stacked projections, as clean -> map -> flag: each cleaned value
    is computed once and the later steps read it as a column (Catalyst
    keeps the layers apart because the values are reused), which keeps the
    generated code small.
    """
    today = as_of_col(as_of)
    c = F.col
    cleaned = raw.select(
        "*",
        clean("amazon_order_id").alias("amazon_order_id_cleaned"),
        to_numeric(c("order_total")).alias("order_total_numeric"),
        F.to_date("purchase_date").alias("order_date"),
        F.to_date("ingested_at").alias("ingest_date"),
        clean("source_file").alias("source_file_cleaned"),
        source_file_date(c("source_file")).alias("source_file_date"),
        clean_upper("currency").alias("currency_cleaned"),
        clean("order_status").alias("order_status_raw"),
        clean("fulfillment_channel").alias("fulfillment_channel_raw"),
        clean_upper("ship_country").alias("ship_country_cleaned"),
    )
    mapped = cleaned.withColumns({
        "order_status_cleaned": map_status(c("order_status_raw")),
        "fulfillment_channel_cleaned": map_fulfillment_channel(c("fulfillment_channel_raw")),
    })
    total = c("order_total_numeric")  # NULL for NaN too, which so counts as missing
    purchased, ingested, updated = c("purchase_date"), c("ingested_at"), c("last_updated_date")
    p_null, p_future, p_old = _date_checks(purchased, c("order_date"), today)
    currency, status, channel, country = (
        c("currency_cleaned"), c("order_status_cleaned"), c("fulfillment_channel_cleaned"),
        c("ship_country_cleaned"))
    return mapped.select(
        *raw.columns,
        "amazon_order_id_cleaned",
        c("amazon_order_id_cleaned").isNull().alias("dq_amazon_order_id_is_null"),
        total.isNull().alias("dq_order_total_is_null"),
        (total.isNotNull() & (total < 0)).alias("dq_order_total_is_negative"),
        "order_total_numeric",
        p_null.alias("dq_purchase_date_is_null"),
        p_future.alias("dq_purchase_date_is_future"),
        p_old.alias("dq_purchase_date_is_too_old"),
        "order_date",
        "ingest_date",
        ingested.isNull().alias("dq_ingested_at_is_null"),
        (ingested.isNotNull() & purchased.isNotNull() & (ingested < purchased))
        .alias("dq_ingested_at_is_before_purchase_date"),
        updated.isNull().alias("dq_last_updated_date_is_null"),
        (updated.isNotNull() & purchased.isNotNull() & (updated < purchased))
        .alias("dq_last_updated_date_is_before_purchase_date"),
        "source_file_cleaned",
        c("source_file_cleaned").isNull().alias("dq_source_file_is_null"),
        "source_file_date",
        # NULL (not FALSE) when the file name holds no date: tested on the
        # raw name, three-valued on purpose.
        (c("ingest_date").isNotNull() & c("source_file").isNotNull()
         & (c("ingest_date") != c("source_file_date"))).alias("dq_source_file_date_mismatch_ingest_date"),
        "currency_cleaned",
        currency.isNull().alias("dq_currency_is_null"),
        invalid_currency(currency).alias("dq_currency_invalid_format"),
        "order_status_raw",
        "order_status_cleaned",
        c("order_status_raw").isNull().alias("dq_order_status_is_null"),
        (status.isNotNull() & ~status.isin(*ALLOWED_STATUSES)).alias("dq_order_status_is_invalid"),
        "fulfillment_channel_raw",
        "fulfillment_channel_cleaned",
        channel.isNull().alias("dq_fulfillment_channel_is_null"),
        (channel.isNotNull() & ~channel.isin(*ALLOWED_CHANNELS)).alias("dq_fulfillment_channel_invalid"),
        "ship_country_cleaned",
        country.isNull().alias("dq_ship_country_is_null"),
        invalid_country(country).alias("dq_ship_country_invalid"),
    )


def stage_storefront(raw: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """15 raw columns + 14 cleaned columns + 11 DQ flags (D21-D31).  Statuses
    are only cleaned and upper-cased here; no vocabulary mapping.  Clean
    first, then flag from the cleaned columns (see :func:`stage_marketplace`)."""
    today = as_of_col(as_of)
    c = F.col
    cleaned = raw.select(
        "*",
        clean("id").alias("id_cleaned"),
        clean("customer_id").alias("customer_id_cleaned"),
        clean("email").alias("email_cleaned"),
        F.to_date("created_at").alias("order_date"),
        to_numeric(c("total_price")).alias("total_price_numeric"),
        to_numeric(c("subtotal_price")).alias("subtotal_price_numeric"),
        to_numeric(c("total_discounts")).alias("total_discounts_numeric"),
        to_numeric(c("total_tax")).alias("total_tax_numeric"),
        clean_upper("currency").alias("currency_cleaned"),
        clean_upper("shipping_country").alias("shipping_country_cleaned"),
        clean("financial_status").alias("financial_status_raw"),
        clean("fulfillment_status").alias("fulfillment_status_raw"),
    )
    created, total = c("created_at"), c("total_price_numeric")
    c_null, c_future, c_old = _date_checks(created, c("order_date"), today)
    currency, country = c("currency_cleaned"), c("shipping_country_cleaned")
    return cleaned.select(
        *raw.columns,
        "id_cleaned",
        c("id_cleaned").isNull().alias("dq_id_is_null"),
        "customer_id_cleaned",
        c("customer_id_cleaned").isNull().alias("dq_customer_id_is_null"),
        "email_cleaned",
        "order_date",
        c_null.alias("dq_created_at_is_null"),
        c_future.alias("dq_created_at_is_future"),
        c_old.alias("dq_created_at_is_too_old"),
        "total_price_numeric", "subtotal_price_numeric", "total_discounts_numeric", "total_tax_numeric",
        total.isNull().alias("dq_total_price_is_null"),
        (total.isNotNull() & (total < 0)).alias("dq_total_price_is_negative"),
        "currency_cleaned",
        currency.isNull().alias("dq_currency_is_null"),
        invalid_currency(currency).alias("dq_currency_invalid_format"),
        "shipping_country_cleaned",
        country.isNull().alias("dq_shipping_country_is_null"),
        invalid_country(country).alias("dq_shipping_country_invalid_format"),
        "financial_status_raw",
        F.upper(c("financial_status_raw")).alias("financial_status_cleaned"),
        "fulfillment_status_raw",
        F.upper(c("fulfillment_status_raw")).alias("fulfillment_status_cleaned"),
    )


MARKETPLACE_CLEANED = (
    "amazon_order_id_cleaned", "order_total_numeric", "order_date", "ingest_date",
    "source_file_cleaned", "source_file_date", "currency_cleaned", "order_status_raw",
    "order_status_cleaned", "fulfillment_channel_raw", "fulfillment_channel_cleaned",
    "ship_country_cleaned",
)
STOREFRONT_CLEANED = (
    "id_cleaned", "customer_id_cleaned", "email_cleaned", "order_date",
    "total_price_numeric", "subtotal_price_numeric", "total_discounts_numeric",
    "total_tax_numeric", "currency_cleaned", "shipping_country_cleaned",
    "financial_status_raw", "financial_status_cleaned", "fulfillment_status_raw",
    "fulfillment_status_cleaned",
)


def dq_columns(df: DataFrame) -> list[str]:
    return [n for n in df.columns if n.startswith("dq_")]
