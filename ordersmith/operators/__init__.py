"""Pipeline operators, one module per layer; each is DataFrame -> DataFrame."""

from .canonical import (
    add_customer_key,
    business_flags,
    canonical_orders,
    dedupe_latest,
    dq_rollup,
    event_time,
    null_id_report,
    standardize_geo,
    standardize_money,
    standardize_status,
)
from .integrate import stack_orders, unify_marketplace, unify_storefront
from .marts import (
    currency_counts,
    customer_lifetime,
    dim_customers,
    dim_customers_joined,
    fact_orders,
    kpi_country_daily,
    kpi_daily_currency,
    kpi_freshness_lag,
    kpi_status_daily,
    multi_currency,
    primary_currency,
    revenue_rule,
)
from .staging import stage_marketplace, stage_storefront

__all__ = [
    "add_customer_key", "business_flags", "canonical_orders", "currency_counts",
    "customer_lifetime", "dedupe_latest", "dim_customers", "dim_customers_joined",
    "dq_rollup", "event_time", "fact_orders", "kpi_country_daily", "kpi_daily_currency",
    "kpi_freshness_lag", "kpi_status_daily", "multi_currency", "null_id_report", "primary_currency",
    "revenue_rule", "stack_orders", "stage_marketplace", "stage_storefront",
    "standardize_geo", "standardize_money", "standardize_status", "unify_marketplace",
    "unify_storefront",
]
