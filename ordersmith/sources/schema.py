"""Declared schemas of the two raw feeds and the unified order shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARKETPLACE_RAW = T.StructType([
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("report_date", T.DateType()),
    T.StructField("amazon_order_id", T.StringType()),
    T.StructField("purchase_date", T.TimestampType()),
    T.StructField("last_updated_date", T.TimestampType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("fulfillment_channel", T.StringType()),
    T.StructField("order_total", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("ship_country", T.StringType()),
    T.StructField("buyer_id", T.StringType()),
])

STOREFRONT_RAW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("financial_status", T.StringType()),
    T.StructField("fulfillment_status", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("total_price", T.DoubleType()),
    T.StructField("subtotal_price", T.DoubleType()),
    T.StructField("total_discounts", T.DoubleType()),
    T.StructField("total_tax", T.DoubleType()),
    T.StructField("shipping_country", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("test", T.BooleanType()),
])

# The 25-column shape both feeds are mapped into before stacking.
UNIFIED = T.StructType([
    T.StructField("order_date", T.DateType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("global_order_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("order_created_at", T.TimestampType()),
    T.StructField("order_processed_at", T.TimestampType()),
    T.StructField("order_updated_at", T.TimestampType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("financial_status", T.StringType()),
    T.StructField("fulfillment_status", T.StringType()),
    T.StructField("fulfillment_channel", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("order_total", T.DecimalType(38, 9)),
    T.StructField("subtotal_price", T.DecimalType(38, 9)),
    T.StructField("total_discounts", T.DecimalType(38, 9)),
    T.StructField("total_tax", T.DecimalType(38, 9)),
    T.StructField("shipping_country", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("report_date", T.DateType()),
    T.StructField("is_test", T.BooleanType()),
    T.StructField("tags", T.StringType()),
])

UNIFIED_COLUMNS = tuple(f.name for f in UNIFIED.fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name, cast to its types (extra input
    columns are dropped).  A cheap projection; raises if a column is missing."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
