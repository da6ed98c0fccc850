"""Golden chain: hand-written raw rows through every layer."""

import datetime as dt
from decimal import Decimal

import pytest

from fixtures import AS_OF, MARKETPLACE, STOREFRONT
from ordersmith import operators as op
from ordersmith.plans import pipeline
from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW


@pytest.fixture(scope="module")
def raw(spark):
    return (spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW),
            spark.createDataFrame(STOREFRONT, STOREFRONT_RAW))


@pytest.fixture(scope="module")
def fact(raw):
    return pipeline.fact(*raw, as_of=AS_OF)


def by(rows, key):
    return {r[key]: r for r in rows}


def test_stage_marketplace_flags(raw):
    rows = op.stage_marketplace(raw[0], AS_OF).collect()
    assert len(rows) == len(MARKETPLACE)
    mismatch = [r["dq_source_file_date_mismatch_ingest_date"] for r in rows]
    # same date, other date, no date, impossible date, blank, NULL name
    assert mismatch[:6] == [False, True, None, None, None, False]
    a3 = rows[4]
    assert a3["amazon_order_id_cleaned"] == "A-3"
    assert a3["order_status_cleaned"] == "COMPLETED"
    assert a3["fulfillment_channel_cleaned"] == "AMAZON"
    assert a3["currency_cleaned"] == "EUR" and a3["ship_country_cleaned"] == "DE"
    assert a3["source_file_cleaned"] is None and a3["dq_source_file_is_null"]
    a4 = rows[5]
    for flag in ("dq_purchase_date_is_future", "dq_ingested_at_is_before_purchase_date",
                 "dq_last_updated_date_is_before_purchase_date", "dq_currency_invalid_format",
                 "dq_ship_country_invalid", "dq_order_status_is_invalid", "dq_fulfillment_channel_invalid",
                 "dq_order_total_is_negative"):
        assert a4[flag] is True, flag
    assert a4["order_status_cleaned"] == "WEIRD" and a4["fulfillment_channel_cleaned"] == "FBX"
    blank = rows[6]
    assert blank["dq_amazon_order_id_is_null"] and blank["dq_purchase_date_is_too_old"]
    assert blank["dq_order_status_is_null"] and blank["dq_order_status_is_invalid"] is False
    assert blank["dq_currency_is_null"] and blank["dq_currency_invalid_format"] is False
    assert blank["dq_order_total_is_null"] and blank["dq_fulfillment_channel_is_null"]
    assert rows[0]["order_total_numeric"] == Decimal("100.000000000")
    undated = rows[-1]
    assert undated["dq_purchase_date_is_null"] is True and undated["order_date"] is None
    assert undated["dq_purchase_date_is_future"] is False and undated["dq_purchase_date_is_too_old"] is False
    assert undated["dq_ingested_at_is_before_purchase_date"] is False


def test_stage_storefront(raw):
    rows = op.stage_storefront(raw[1], AS_OF).collect()
    assert len(rows) == len(STOREFRONT)
    s2 = rows[1]
    assert s2["financial_status_cleaned"] == "PENDING" and s2["currency_cleaned"] == "USD"
    assert s2["shipping_country_cleaned"] == "US"
    assert rows[4]["id_cleaned"] is None and rows[4]["dq_id_is_null"]
    assert rows[12]["dq_customer_id_is_null"] and rows[12]["customer_id_cleaned"] is None
    assert rows[8]["dq_currency_is_null"] and not rows[8]["dq_currency_invalid_format"]
    undated = rows[-1]
    assert undated["dq_created_at_is_null"] is True and undated["dq_created_at_is_future"] is False
    assert undated["dq_id_is_null"] is True


def test_canonical(raw):
    rows = pipeline.canonical(*raw, as_of=AS_OF).collect()
    assert len(rows) == 17
    nulls = [r for r in rows if r["global_order_id"] is None]
    assert len(nulls) == 1  # all blank ids share one window partition
    assert nulls[0]["source_system"] == "shopify" and nulls[0]["dq_global_order_id_is_null"]
    c = by(rows, "global_order_id")
    assert c["amazon:A-1"]["order_status_canon"] == "RETURNED"  # later update wins
    assert c["amazon:A-1"]["ingest_date"] == dt.date(2025, 6, 5)
    assert c["amazon:A-2"]["order_status_canon"] == "CANCELLED"  # later ingest wins
    assert c["amazon:A-3"]["order_total_num"] == Decimal("2.680000000")
    assert c["amazon:A-3"]["global_customer_id"] == "amazon:b3"
    assert c["amazon:A-4"]["dq_has_issue"] and c["amazon:A-4"]["global_customer_id"] is None
    assert c["shopify:S-1"]["fulfillment_status_canon"] == "CANCELLED"
    assert c["shopify:S-2"]["is_test_order"] is None
    assert c["shopify:S-4"]["is_test_order"] is True
    assert c["amazon:A-1"]["is_test_order"] is False
    assert c["shopify:S-6"]["order_status_canon"] == "REFUNDED"  # later processing wins
    s12 = c["shopify:S-12"]
    assert s12["is_cancelled"] is None and s12["is_refund_or_return"] is None
    assert all(r["rn"] == 1 for r in rows)
    assert c["shopify:S-1"]["order_event_date"] == dt.date(2025, 6, 1)


def test_keep_null_ids(raw):
    stacked = pipeline.stacked(*raw, as_of=AS_OF)
    kept = op.dedupe_latest(stacked, keep_null_ids=True).where("global_order_id IS NULL").count()
    assert kept == 5  # three marketplace and two storefront rows without an id
    assert op.fact_orders(op.canonical_orders(stacked, keep_null_ids=True)).where(
        "global_order_id IS NULL").count() == 5


def test_revenue_rule(fact):
    f = by(fact.collect(), "global_order_id")
    eligible = {k for k, r in f.items() if r["is_revenue_eligible"]}
    assert eligible == {"amazon:A-3", "amazon:A-7", "shopify:S-1", "shopify:S-2", "shopify:S-7", "shopify:S-8",
                        "shopify:S-9", "shopify:S-10", "shopify:S-11", "shopify:S-12", None}
    assert f["amazon:A-7"]["revenue_amount"] == 0
    assert f["amazon:A-1"]["revenue_amount"] == 0 and f["shopify:S-3"]["revenue_amount"] == 0
    assert f["shopify:S-1"]["revenue_amount"] == Decimal("49.9")


def test_kpi_daily_currency(fact):
    k = op.kpi_daily_currency(fact, orders_unique=True).collect()
    a4 = [r for r in k if r["order_date"] == dt.date(2026, 1, 1)][0]
    assert (a4["rows_in_fact"], a4["orders_total"], a4["customers_total"]) == (1, 1, 0)
    assert a4["aov"] is None and a4["orders_revenue_eligible"] == 0
    assert sum(r["revenue"] for r in k) == Decimal("105.58")  # 2.68 + 49.9 + 10 + 15 + 5 + 5 + 7 + 7 + 3 + 1
    exact = op.kpi_daily_currency(fact).collect()
    assert sorted(map(tuple, k), key=str) == sorted(map(tuple, exact), key=str)


def test_dim_customers(fact):
    d = by(op.dim_customers(fact, AS_OF).collect(), "global_customer_id")
    assert len(d) == 10
    c1 = d["shopify:c1"]
    assert (c1["primary_currency"], c1["num_currencies_used"], c1["is_multi_currency_customer"]) == ("USD", 2, True)
    assert c1["lifetime_orders_revenue_eligible"] == 3 and c1["lifetime_revenue"] == Decimal("74.9")
    assert c1["any_email"] == "a@shop.test" and c1["days_since_last_order_any"] == 23
    c2 = d["shopify:c2"]
    assert c2["primary_currency"] is None and c2["num_currencies_used"] == 0
    assert c2["first_order_date_revenue_eligible"] is None and c2["lifetime_revenue"] == 0
    assert d["shopify:c4"]["primary_currency"] is None  # NULL currency wins the tie
    assert d["shopify:c4"]["num_currencies_used"] == 2
    assert d["shopify:c5"]["primary_currency"] == "AUD"  # smallest code wins the tie
    assert d["amazon:b7"]["primary_currency"] == "CHF" and d["amazon:b7"]["lifetime_revenue"] == 0
    joined = op.dim_customers_joined(fact, AS_OF).collect()
    assert sorted(map(tuple, joined), key=str) == sorted(map(tuple, d.values()), key=str)


def test_freshness(fact):
    rows = by(op.kpi_freshness_lag(fact).collect(), "ingest_date")
    assert len(rows) == 5  # storefront has no ingest date
    assert rows[dt.date(2025, 6, 5)]["max_lag_days"] == 4 and rows[dt.date(2025, 6, 5)]["late_orders_gt_2d"] == 1
    assert rows[dt.date(2025, 6, 13)]["late_rate_gt_2d"] == 1.0
    assert rows[dt.date(2025, 6, 4)]["late_orders_gt_2d"] == 0  # lag 2 is not late
    assert rows[dt.date(2025, 12, 31)]["avg_lag_days"] == -1.0
