"""Exact counts without Expand, the joined dimension on one base, NULL ids in one pass."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, physical_plan
from fixtures import AS_OF, MARKETPLACE, STOREFRONT
from ordersmith import operators as op
from ordersmith.plans import pipeline
from ordersmith.plans.registry import present
from ordersmith.session import scratch_path
from ordersmith.sources.feeds import AS_OF as Q_AS_OF, feeds_from_dir
from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW


@pytest.fixture(scope="module")
def repeated(spark):
    """Rows whose orders repeat, have several customers, or no id; few days, NULL keys."""
    rng = random.Random(8)
    rows = []
    for i in range(4000):
        order = rng.choice([None, f"o{rng.randrange(300)}", "junk"])
        rows.append((rng.choice([None, "2025-01-01", "2025-01-02"]), "amazon", rng.choice([None, "EUR", "USD"]), rng.choice(["DE", None]), rng.choice(["SHIPPED", None]), order,
                     rng.choice([None, f"c{rng.randrange(200)}"]), bool(i % 3), float(i % 50), rng.choice([None, True, False]), bool(i % 7 == 0), bool(i % 2)))
    df = spark.createDataFrame(rows, "d string, source_system string, currency_canon string, shipping_country_canon string, order_status_canon string, global_order_id string, "
                               "global_customer_id string, is_revenue_eligible boolean, x double, is_cancelled boolean, is_refund_or_return boolean, dq_has_issue boolean")
    return df.withColumn("order_date", F.col("d").cast("date")).withColumn("revenue_amount", F.col("x").cast("decimal(38,9)"))


@pytest.mark.parametrize("mart,keys,orders,customers", [
    (op.kpi_daily_currency, ["order_date", "source_system", "currency_canon"], "orders_total", "customers_total"),
    (op.kpi_country_daily, ["order_date", "source_system", "shipping_country_canon", "currency_canon"], "orders_total", "customers_total"),
    (op.kpi_status_daily, ["order_date", "source_system", "order_status_canon"], "orders", "customers")])
def test_same_as_sparks_distinct_counts(repeated, mart, keys, orders, customers):
    got = mart(repeated)
    want = repeated.groupBy(*keys).agg(F.count_distinct("global_order_id").alias(orders), F.count_distinct("global_customer_id").alias(customers), F.sum("revenue_amount").alias("revenue"))
    assert "Expand" in physical_plan(want) and "Expand" not in physical_plan(got)
    money = "revenue" if "revenue" in got.columns else "revenue_eligible_only"
    a = got.select(*keys, orders, customers, F.col(money).alias("revenue"))
    assert a.exceptAll(want).isEmpty() and want.exceptAll(a).isEmpty()
    if mart is op.kpi_daily_currency:
        rest = repeated.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_in_fact"), F.count_if("is_revenue_eligible").alias("orders_revenue_eligible"), F.count_if("is_cancelled").alias("cancelled_orders"))
        assert got.select(*rest.columns).exceptAll(rest).isEmpty()


def test_joined_dimension_needs_one_dedupe_and_no_more_exchange(spark):
    fact = pipeline.fact(*feeds_from_dir(spark, SMALL), as_of=Q_AS_OF)
    joined = op.dim_customers_joined(fact, Q_AS_OF)
    p = physical_plan(joined)
    assert "global_order_id" not in p and "Exchange" not in p  # the dedupe is behind the checkpoint, both joins are in place
    assert p.count("SortMergeJoin") + p.count("ShuffledHashJoin") == 2 and "Broadcast" not in p
    a, b = present(joined), present(op.dim_customers(fact, Q_AS_OF))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_customer_is_few_rows_in_the_joined_base(spark):
    i = F.col("id")
    m = spark.range(5000).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in MARKETPLACE_RAW.fields if f.name not in ("amazon_order_id", "buyer_id", "order_total", "currency")),
                                 F.concat(F.lit("H-"), i.cast("string")).alias("amazon_order_id"), F.lit("hot").alias("buyer_id"), F.lit(1.0).alias("order_total"), F.lit("EUR").alias("currency"))
    fact = pipeline.fact(m, spark.createDataFrame(STOREFRONT, STOREFRONT_RAW), AS_OF)
    row = op.dim_customers_joined(fact, AS_OF).where("global_customer_id = 'amazon:hot'").first()
    assert row["lifetime_orders_revenue_eligible"] == 5000 and row["primary_currency"] == "EUR"
    assert op.marts._per_email(fact).where("global_customer_id = 'amazon:hot'").count() == 1


def test_null_ids_are_kept_in_one_pass(spark):
    stack = pipeline.stacked(spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW), spark.createDataFrame(STOREFRONT, STOREFRONT_RAW), AS_OF)
    path = scratch_path(spark, "stack")
    stack.unionByName(stack.where("global_order_id is null")).write.parquet(path)  # repeated NULL-id rows too
    rows = spark.read.parquet(path)
    kept = op.dedupe_latest(rows, keep_null_ids=True)
    p = physical_plan(kept)
    assert p.count("FileScan") == 1 and len(re.findall("Exchange hashpartitioning", p)) == 1 and "Union" not in p
    assert kept.columns == op.dedupe_latest(rows).columns
    loose = kept.where("global_order_id is null")
    want = rows.where("global_order_id is null").withColumn("rn", F.lit(None).cast("bigint"))
    assert loose.exceptAll(want).isEmpty() and want.exceptAll(loose).isEmpty() and loose.count() > 2
    a, b = kept.where("global_order_id is not null"), op.dedupe_latest(rows).where("global_order_id is not null")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
