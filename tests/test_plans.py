"""Plan shape guards: the properties the scale design relies on."""

import re

import pytest

from conftest import SMALL, physical_plan
from ordersmith import operators as op
from ordersmith.plans import pipeline
from ordersmith.plans.sinks import LAYOUTS, read_table, write_table
from ordersmith.session import scratch_path
from ordersmith.sources.feeds import AS_OF, feeds_from_dir


def plan(df) -> str:
    return physical_plan(df)


def hash_exchanges(p: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", p))


@pytest.fixture(scope="module")
def fact_table(spark):
    fact = pipeline.fact(*feeds_from_dir(spark, SMALL), as_of=AS_OF)
    path = scratch_path(spark, "fact_plans")
    write_table(fact, path, LAYOUTS["mart_fact_orders"])
    return read_table(spark, path, fact.schema)


def test_dedupe_is_one_shuffle_with_map_side_limit(spark):
    p = plan(pipeline.canonical(*feeds_from_dir(spark, SMALL), as_of=AS_OF))
    assert hash_exchanges(p) == 1 and re.search(r"hashpartitioning\([^)]*global_order_id", p), p
    assert p.count("WindowGroupLimit") == 2  # before and after the exchange


@pytest.mark.parametrize("mart", [op.kpi_daily_currency, op.kpi_country_daily, op.kpi_status_daily,
                                  op.kpi_freshness_lag])
def test_kpi_marts_have_no_expand_and_combine_map_side(fact_table, mart):
    p = plan(mart(fact_table, orders_unique=True))  # as the refresh calls them, after dedupe
    assert "Expand" not in p
    assert "partial_count" in p or "partial_sum" in p
    assert hash_exchanges(p) <= 2


def test_kpi_scan_reads_only_needed_columns(fact_table):
    p = plan(op.kpi_daily_currency(fact_table, orders_unique=True))
    scanned = re.search(r"FileScan parquet [^\[]*\[([^\]]*)\]", p).group(1)
    cols = {c.split("#")[0] for c in scanned.split(",")}
    assert "revenue_amount" in cols and "order_created_at" not in cols and len(cols) < 12


def test_dimension_has_no_join_and_pushes_filter(fact_table):
    p = plan(op.dim_customers(fact_table, AS_OF))
    assert "Join" not in p
    assert hash_exchanges(p) == 3
    assert "PushedFilters: [IsNotNull(global_customer_id)]" in p
    # the aggregation over the fact rows hashes (no sort of the fact); only
    # the levels over aggregated rows sort
    lines = [ln.strip() for ln in p.splitlines()]
    scan = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln)
    first_agg = next(ln for ln in reversed(lines[:scan]) if "Aggregate" in ln)
    assert "HashAggregate" in first_agg
