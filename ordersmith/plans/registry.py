"""Registered queries: each builds one pipeline step from the driver's
tables and returns it in a comparison-friendly shape.

Every query reads ``lineitem``/``orders``/``customer`` of the given folder
in full, derives the two raw feeds, and runs the pipeline up to the step it
names.  :func:`present` only changes types for comparison with the SQL
oracle: NUMERIC becomes DOUBLE (sums of 2-place money go through
DECIMAL(38,2) so the conversion is exact) and INT becomes BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..session import scratch_path
from ..sources.feeds import AS_OF, feeds_from_dir
from ..sources.files import TIMESTAMP_FORMAT, append_feed_csv, load_feed_csv, read_feed_csv, write_feed_csv
from ..sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW, UNIFIED_COLUMNS
from . import pipeline, versions
from .sinks import LAYOUTS, Narrow, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Sums of money rounded to 2 places: exact at DECIMAL(38,2).
SUMMED_MONEY = ("revenue", "revenue_eligible_only", "lifetime_revenue")


def present(df: DataFrame, exact_2dp: Iterable[str] = SUMMED_MONEY) -> DataFrame:
    exact = set(exact_2dp)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = (c.cast("decimal(38,2)") if f.name in exact else c).cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _staged(spark: SparkSession, sf_dir: str):
    m, s = feeds_from_dir(spark, sf_dir)
    return op.stage_marketplace(m, AS_OF), op.stage_storefront(s, AS_OF)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, s = feeds_from_dir(spark, sf_dir)
    return pipeline.canonical(m, s, AS_OF)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fact_orders(_canonical(spark, sf_dir))


def stage_amazon_clean(spark, sf_dir):
    stg, _ = _staged(spark, sf_dir)
    return present(stg.select(*MARKETPLACE_RAW.fieldNames(), *op.staging.MARKETPLACE_CLEANED))


def stage_amazon_dq(spark, sf_dir):
    stg, _ = _staged(spark, sf_dir)
    return present(stg.select("amazon_order_id", "ingested_at", "source_file", *op.staging.dq_columns(stg)))


def stage_shopify_clean(spark, sf_dir):
    _, stg = _staged(spark, sf_dir)
    return present(stg.select(*STOREFRONT_RAW.fieldNames(), *op.staging.STOREFRONT_CLEANED))


def stage_shopify_dq(spark, sf_dir):
    _, stg = _staged(spark, sf_dir)
    return present(stg.select("id", "created_at", "processed_at", *op.staging.dq_columns(stg)))


def unify_amazon(spark, sf_dir):
    stg, _ = _staged(spark, sf_dir)
    return present(op.unify_marketplace(stg))


def unify_shopify(spark, sf_dir):
    _, stg = _staged(spark, sf_dir)
    return present(op.unify_storefront(stg))


def stack_orders(spark, sf_dir):
    m, s = feeds_from_dir(spark, sf_dir)
    return present(pipeline.stacked(m, s, AS_OF))


def dedupe_latest(spark, sf_dir):
    m, s = feeds_from_dir(spark, sf_dir)
    return present(op.dedupe_latest(pipeline.stacked(m, s, AS_OF)))


def null_id_report(spark, sf_dir):
    m, s = feeds_from_dir(spark, sf_dir)
    return op.null_id_report(pipeline.stacked(m, s, AS_OF))


def canonical_status(spark, sf_dir):
    return present(_canonical(spark, sf_dir).select(
        "global_order_id", "source_system", "order_status", "financial_status", "fulfillment_status",
        "customer_id", "global_customer_id", "order_status_canon", "payment_status", "fulfillment_status_canon"))


def canonical_money(spark, sf_dir):
    return present(_canonical(spark, sf_dir).select(
        "global_order_id", "source_system", "order_total", "subtotal_price", "total_discounts", "total_tax",
        "order_total_num", "subtotal_price_num", "total_discounts_num", "total_tax_num"))


def canonical_geo(spark, sf_dir):
    return present(_canonical(spark, sf_dir).select(
        "global_order_id", "source_system", "currency", "shipping_country", "currency_canon",
        "shipping_country_canon"))


def canonical_flags_dq(spark, sf_dir):
    return present(_canonical(spark, sf_dir).select(
        "global_order_id", "source_system", "is_test", "order_status_canon", "is_test_order", "is_cancelled",
        "is_refund_or_return", *op.canonical.CANONICAL_DQ_FLAGS, "dq_has_issue"))


def canonical_event_time(spark, sf_dir):
    return present(_canonical(spark, sf_dir).select(
        "global_order_id", "source_system", "order_created_at", "order_processed_at", "order_updated_at",
        "order_event_ts", "order_event_date"))


def canonical_orders(spark, sf_dir):
    return present(_canonical(spark, sf_dir))


def fact_orders(spark, sf_dir):
    return present(_fact(spark, sf_dir))


def revenue_rule(spark, sf_dir):
    return present(_fact(spark, sf_dir).select(
        "global_order_id", "source_system", "order_status_canon", "order_total_num", "is_test_order",
        "is_cancelled", "is_refund_or_return", "is_revenue_eligible", "revenue_amount"))


def kpi_daily_currency(spark, sf_dir):
    return present(op.kpi_daily_currency(_fact(spark, sf_dir), orders_unique=True))


def kpi_country_daily(spark, sf_dir):
    return present(op.kpi_country_daily(_fact(spark, sf_dir), orders_unique=True))


def kpi_status_daily(spark, sf_dir):
    return present(op.kpi_status_daily(_fact(spark, sf_dir), orders_unique=True))


def kpi_daily_currency_exact(spark, sf_dir):
    """A02: exact distinct orders and customers over the stacked rows, where an
    order may occur many times (no dedupe before the revenue rule)."""
    m, s = feeds_from_dir(spark, sf_dir)
    rows = op.canonical.standardize(pipeline.stacked(m, s, AS_OF))
    return present(op.kpi_daily_currency(op.revenue_rule(rows)))


def customer_lifetime(spark, sf_dir):
    return present(op.customer_lifetime(_fact(spark, sf_dir)))


def currency_counts(spark, sf_dir):
    return present(op.currency_counts(_fact(spark, sf_dir)))


def primary_currency(spark, sf_dir):
    return present(op.primary_currency(op.currency_counts(_fact(spark, sf_dir))))


def multi_currency(spark, sf_dir):
    return present(op.multi_currency(op.currency_counts(_fact(spark, sf_dir))))


def dim_customers(spark, sf_dir):
    return present(op.dim_customers(_fact(spark, sf_dir), AS_OF))


def dim_customers_joined(spark, sf_dir):
    return present(op.dim_customers_joined(_fact(spark, sf_dir), AS_OF))


def kpi_freshness_lag(spark, sf_dir):
    return present(op.kpi_freshness_lag(_fact(spark, sf_dir), orders_unique=True))


def sink_roundtrip(spark, sf_dir):
    """Write the fact as a date-partitioned, clustered table in the shared
    checkpoint folder, then read it back (S03-S06)."""
    m, s = feeds_from_dir(spark, sf_dir)
    path = scratch_path(spark, "mart_fact_orders")
    with pipeline.latest_orders(pipeline.stacked(m, s, AS_OF)) as orders:
        fact = pipeline.keyed_fact(orders)
        write_table(fact, path, LAYOUTS["mart_fact_orders"])
    return present(read_table(spark, path, fact.schema))


def sink_overwrite(spark, sf_dir):
    """Replace a published table twice, first by the fact with every day moved back
    40 years, in a session set to keep the days a write lacks; a reader must then
    see the second version alone (S04)."""
    m, s = feeds_from_dir(spark, sf_dir)
    root, name = scratch_path(spark, "replaced"), "mart_fact_orders"
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, None)
    spark.conf.set(mode, "dynamic")
    try:
        with pipeline.latest_orders(pipeline.stacked(m, s, AS_OF)) as orders:
            fact = pipeline.keyed_fact(orders)
            moved = fact.rows.withColumn("order_date", F.add_months("order_date", -480))
            versions.replace_table(Narrow(moved, fact.finish, fact.pieces), root, name)
            versions.replace_table(fact, root, name)
    finally:
        spark.conf.unset(mode) if before is None else spark.conf.set(mode, before)
    return present(versions.open_table(spark, root, name, fact.schema))


def refresh_ten_tables(spark, sf_dir):
    """One full refresh of the ten tables, published together; the rows of each
    table as a reader finds them (S03, S04)."""
    m, s = feeds_from_dir(spark, sf_dir)
    root = scratch_path(spark, "refreshed")
    pipeline.full_refresh(spark, m, s, root, AS_OF)
    rows = None
    for name, path in sorted(versions.current(spark, root).items()):
        n = spark.read.parquet(path).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        rows = n if rows is None else rows.unionByName(n)
    return rows


def raw_csv_scan(spark, sf_dir):
    """Write both raw feeds as CSV snapshots (header, empty = NULL, time
    stamps with their zone), scan them back with the declared schemas (S01, S02, S07)
    and stack them."""
    m, s = feeds_from_dir(spark, sf_dir)
    m_path, s_path = scratch_path(spark, "very_raw_amazon_orders"), scratch_path(spark, "very_raw_shopify_orders")
    write_feed_csv(m, m_path)
    write_feed_csv(s, s_path)
    m2 = read_feed_csv(spark, m_path, MARKETPLACE_RAW)
    s2 = read_feed_csv(spark, s_path, STOREFRONT_RAW)
    return present(pipeline.stacked(m2, s2, AS_OF).select(*UNIFIED_COLUMNS))


# Stand-in dirt for CSV lines: order ids with these endings get a bad number, a bad time, a short row.
BAD_NUMBER, BAD_TIME, SHORT_ROW = "17", "23", "41"


def _dirty_csv(spark, sf_dir) -> str:
    """The marketplace feed as a CSV snapshot in which some lines are malformed."""
    m, _ = feeds_from_dir(spark, sf_dir)
    ends = F.col("amazon_order_id").endswith
    times = [f.name for f in MARKETPLACE_RAW.fields if isinstance(f.dataType, T.TimestampType)]
    lines = m.withColumns({n: F.date_format(n, TIMESTAMP_FORMAT) for n in times})
    lines = lines.withColumn("order_total", F.when(ends(BAD_NUMBER), F.lit("12,5 EUR")).otherwise(F.col("order_total").cast("string")))
    lines = lines.withColumn("purchase_date", F.when(ends(BAD_TIME), F.lit("yesterday")).otherwise(F.col("purchase_date")))
    path = scratch_path(spark, "dirty_amazon_orders")
    short = F.coalesce(ends(SHORT_ROW), F.lit(False))
    write_feed_csv(lines.where(~short), path)
    append_feed_csv(lines.where(short).select(*MARKETPLACE_RAW.fieldNames()[:6]), path)
    return path


def raw_csv_malformed(spark, sf_dir):
    """S07: load and stage a snapshot with malformed lines; every row is there, bad
    fields are NULL, and the row says so."""
    raw = load_feed_csv(spark, _dirty_csv(spark, sf_dir), MARKETPLACE_RAW)
    return present(op.stage_marketplace(raw, AS_OF).select(
        *MARKETPLACE_RAW.fieldNames(), "dq_row_is_malformed", "dq_order_total_is_null", "dq_purchase_date_is_null",
        "dq_currency_is_null"))


def dedupe_keep_null_ids(spark, sf_dir):
    """P09 with every row of NULL id kept: latest row per id, ``rn`` NULL for the others."""
    m, s = feeds_from_dir(spark, sf_dir)
    return present(op.dedupe_latest(pipeline.stacked(m, s, AS_OF), keep_null_ids=True))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    stage_amazon_clean, stage_amazon_dq, stage_shopify_clean, stage_shopify_dq,
    unify_amazon, unify_shopify, stack_orders, dedupe_latest,
    canonical_status, canonical_money, canonical_geo, canonical_flags_dq, canonical_event_time,
    canonical_orders, fact_orders, revenue_rule,
    kpi_daily_currency, kpi_daily_currency_exact, kpi_country_daily, kpi_status_daily,
    customer_lifetime, currency_counts, primary_currency, multi_currency,
    dim_customers, dim_customers_joined, kpi_freshness_lag,
    sink_roundtrip, sink_overwrite, refresh_ten_tables, raw_csv_scan, raw_csv_malformed, null_id_report,
    dedupe_keep_null_ids,
)}
