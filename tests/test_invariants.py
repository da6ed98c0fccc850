"""Invariants on the driver's small tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, physical_plan
from ordersmith import operators as op
from ordersmith.plans import pipeline
from ordersmith.functions import ALLOWED_STATUSES
from ordersmith.sources.feeds import AS_OF, feeds_from_dir, load_tables, marketplace_feed, storefront_feed


@pytest.fixture(scope="module")
def feeds(spark):
    return feeds_from_dir(spark, SMALL)


@pytest.fixture(scope="module")
def canon(feeds):
    df = pipeline.canonical(*feeds, as_of=AS_OF).cache()
    yield df
    df.unpersist()  # cached plans would otherwise replace the plans other modules inspect


@pytest.fixture(scope="module")
def fact(canon):
    df = op.fact_orders(canon).cache()
    yield df
    df.unpersist()


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_row_counts(feeds):
    m, s = feeds
    assert op.stage_marketplace(m, AS_OF).count() == m.count()
    assert op.stage_storefront(s, AS_OF).count() == s.count()
    assert pipeline.stacked(m, s, AS_OF).count() == m.count() + s.count()


def test_order_ids_unique(canon):
    dup = canon.where("global_order_id IS NOT NULL").groupBy("global_order_id").count().where("count > 1")
    assert dup.isEmpty()
    assert canon.where("global_order_id IS NULL").count() <= 1


def test_revenue_agrees_across_marts(fact):
    total = fact.agg(F.sum("revenue_amount")).first()[0]
    for mart in (op.kpi_daily_currency(fact), op.kpi_country_daily(fact)):
        assert mart.agg(F.sum("revenue")).first()[0] == total
    assert op.kpi_status_daily(fact).agg(F.sum("revenue_eligible_only")).first()[0] == total
    assert op.dim_customers(fact, AS_OF).agg(F.sum("lifetime_revenue")).first()[0] == \
        fact.where("global_customer_id IS NOT NULL").agg(F.sum("revenue_amount")).first()[0]


def test_dq_has_issue_is_or_of_parts(canon):
    parts = " OR ".join(op.canonical.CANONICAL_DQ_FLAGS)
    assert canon.where(f"dq_has_issue <> ({parts})").isEmpty()
    assert canon.where("dq_has_issue IS NULL").isEmpty()


def test_revenue_amount(fact):
    assert fact.where("is_revenue_eligible AND revenue_amount <> order_total_num").isEmpty()
    assert fact.where("NOT is_revenue_eligible AND revenue_amount <> 0").isEmpty()


def test_dedupe_independent_of_input_order(feeds, canon):
    m, s = feeds
    shuffled = pipeline.canonical(m.repartition(7).orderBy(F.rand(3)), s.repartition(3, "id"), as_of=AS_OF)
    assert same_rows(canon, shuffled)


def test_distinct_shortcut_matches_exact(fact):
    for mart in (op.kpi_daily_currency, op.kpi_country_daily, op.kpi_status_daily, op.kpi_freshness_lag):
        assert same_rows(mart(fact), mart(fact, orders_unique=True))


def test_one_pass_dimension_matches_joins(fact):
    assert same_rows(op.dim_customers(fact, AS_OF), op.dim_customers_joined(fact, AS_OF))


def test_top1_plan_limits_before_shuffle(feeds):
    plan = physical_plan(pipeline.canonical(*feeds, as_of=AS_OF))
    assert "WindowGroupLimit" in plan


def test_every_flag_is_raised_and_not_raised(feeds, canon):
    m, s = feeds
    frames = {"marketplace": op.stage_marketplace(m, AS_OF), "storefront": op.stage_storefront(s, AS_OF), "canonical": canon}
    for name, df in frames.items():
        flags = [c for c in df.columns if c.startswith("dq_")]
        seen = df.agg(*[F.struct(F.max(c).alias("hi"), F.min(c).alias("lo")).alias(c) for c in flags]).first()
        for c in flags:
            assert seen[c]["hi"] is True and seen[c]["lo"] is False, (name, c)
        assert len(flags) == {"marketplace": 20, "storefront": 11, "canonical": 8}[name]


def test_every_status_word_occurs(canon):
    words = {r[0] for r in canon.select("order_status_canon").distinct().collect()}
    assert set(ALLOWED_STATUSES) <= words and {None, "MYSTERY"} <= words


def test_lines_without_a_parent_stay(spark):
    t = load_tables(spark, SMALL)
    none = t["orders"].limit(0), t["customer"].limit(0)
    assert marketplace_feed(t["lineitem"], *none).count() == t["lineitem"].count()
    assert storefront_feed(t["orders"], none[1]).select("id").distinct().count() == \
        storefront_feed(t["orders"], t["customer"]).select("id").distinct().count()


def test_null_id_report(feeds):
    rows = pipeline.stacked(*feeds, as_of=AS_OF)
    got = op.null_id_report(rows).first()
    kept = op.dedupe_latest(rows).where("global_order_id IS NULL").count()
    assert kept == 1 and got["null_id_rows"] > 1
    assert got["null_id_rows_dropped"] == got["null_id_rows"] - kept
    assert op.null_id_report(rows.limit(0)).first().asDict() == {"stacked_rows": 0, "null_id_rows": 0, "null_id_rows_dropped": 0}
