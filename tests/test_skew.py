"""Hot keys: one order id and one customer each hold a third of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, MARKETPLACE, STOREFRONT
from ordersmith import operators as op
from ordersmith.plans import pipeline
from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW, conform

N = 3000


@pytest.fixture(scope="module")
def feeds(spark):
    base = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    i = F.col("id")
    start = F.lit(dt.datetime(2025, 6, 1, 10, 0))
    # One order re-reported N times; report k updates it k minutes later.
    hot_order = spark.range(N).select(
        (start + F.make_interval(days=F.lit(1))).alias("ingested_at"),
        F.lit("reports/2025-06-02.tsv").alias("source_file"),
        F.lit(dt.date(2025, 6, 2)).alias("report_date"),
        F.lit("A-HOT").alias("amazon_order_id"),
        start.alias("purchase_date"),
        (start + F.make_interval(mins=i.cast("int"))).alias("last_updated_date"),
        F.when(i == N - 1, F.lit("Returned")).otherwise(F.lit("Shipped")).alias("order_status"),
        F.lit("AFN").alias("fulfillment_channel"),
        F.lit(10.0).alias("order_total"),
        F.lit("EUR").alias("currency"), F.lit("DE").alias("ship_country"), F.lit("b-hot-order").alias("buyer_id"))
    # One customer with N distinct orders, every fifth in USD.
    hot_customer = spark.range(N).select(
        (start + F.make_interval(days=F.lit(1))).alias("ingested_at"),
        F.lit("reports/2025-06-02.tsv").alias("source_file"),
        F.lit(dt.date(2025, 6, 2)).alias("report_date"),
        F.concat(F.lit("C-"), i.cast("string")).alias("amazon_order_id"),
        start.alias("purchase_date"),
        F.lit(None).cast("timestamp").alias("last_updated_date"),
        F.lit("Shipped").alias("order_status"),
        F.lit("MFN").alias("fulfillment_channel"),
        (i % 7).cast("double").alias("order_total"),
        F.when(i % 5 == 0, F.lit("USD")).otherwise(F.lit("EUR")).alias("currency"),
        F.lit("DE").alias("ship_country"), F.lit("b-hot").alias("buyer_id"))
    m = base.unionByName(conform(hot_order, MARKETPLACE_RAW)).unionByName(conform(hot_customer, MARKETPLACE_RAW))
    return m, spark.createDataFrame(STOREFRONT, STOREFRONT_RAW)


def test_hot_order_keeps_latest_version(feeds):
    canon = pipeline.canonical(*feeds, as_of=AS_OF)
    hot = canon.where("global_order_id = 'amazon:A-HOT'").collect()
    assert len(hot) == 1
    assert hot[0]["order_status_canon"] == "RETURNED"
    assert hot[0]["order_updated_at"] == dt.datetime(2025, 6, 1, 10, 0) + dt.timedelta(minutes=N - 1)
    assert canon.count() == 17 + 1 + N


def test_hot_customer_lifetime(feeds):
    fact = pipeline.fact(*feeds, as_of=AS_OF)
    d = op.dim_customers(fact, AS_OF).where("global_customer_id = 'amazon:b-hot'").first()
    assert d["lifetime_orders_revenue_eligible"] == N
    assert float(d["lifetime_revenue"]) == float(sum(k % 7 for k in range(N)))
    assert d["primary_currency"] == "EUR" and d["num_currencies_used"] == 2
    kpi = op.kpi_daily_currency(fact).where("order_date = DATE'2025-06-01' AND source_system = 'amazon'")
    by_ccy = {r["currency_canon"]: r for r in kpi.collect()}
    assert by_ccy["USD"]["orders_total"] == N // 5 and by_ccy["USD"]["customers_total"] == 1
    assert by_ccy["EUR"]["customers_total"] == 3  # hot customer, hot order's buyer, fixture A-1 (b1)


def test_results_do_not_depend_on_partitioning(spark, feeds):
    fact = pipeline.fact(*feeds, as_of=AS_OF)
    a = op.dim_customers(fact, AS_OF)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = op.dim_customers(pipeline.fact(feeds[0].repartition(5), feeds[1], as_of=AS_OF), AS_OF)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_null_id_group_holding_a_third_of_rows(spark, feeds):
    m, s = feeds
    blank = m.where("amazon_order_id = 'A-HOT'").withColumn("amazon_order_id", F.lit("  "))
    canon = pipeline.canonical(m.unionByName(blank), s, as_of=AS_OF)
    nulls = canon.where("global_order_id IS NULL").collect()
    assert len(nulls) == 1  # N blank-id reports and the fixture's NULL ids collapse to one row
    # The latest event wins: the fixture's storefront row (2025-06-04 13:00)
    # is later than the hot rows' last update (2025-06-03 11:59).
    assert nulls[0]["source_system"] == "shopify"
    assert nulls[0]["order_created_at"] == dt.datetime(2025, 6, 4, 13, 0)
    kept = op.dedupe_latest(pipeline.stacked(m.unionByName(blank), s, AS_OF), keep_null_ids=True)
    assert kept.where("global_order_id IS NULL").count() == N + 5  # bypass keeps every NULL-id row
