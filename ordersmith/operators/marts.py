"""Mart layer: the order fact with one revenue rule, KPI aggregates, the
customer dimension and the load-freshness table.

Every aggregate is a ``groupBy().agg()`` so Spark does a partial (map-side)
aggregation before the shuffle; a hot day, currency or customer therefore
sends one partial row per task, not all of its rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_of_col, count_true, day_diff, safe_ratio
from ..session import checkpoint_dir, planned_ahead


# The fact's carried columns, in output order.
FACT_CARRIED = (
    "global_order_id", "source_system", "order_id", "global_customer_id", "customer_id", "email",
    "order_date", "order_created_at", "order_processed_at", "order_updated_at", "order_event_ts",
    "order_event_date", "ingest_date", "report_date",
    "order_status", "financial_status", "fulfillment_status", "order_status_canon", "payment_status",
    "fulfillment_status_canon",
    "currency", "currency_canon", "shipping_country", "shipping_country_canon", "fulfillment_channel",
    "order_total", "subtotal_price", "total_discounts", "total_tax", "order_total_num",
    "subtotal_price_num", "total_discounts_num", "total_tax_num",
    "is_test", "tags", "is_test_order", "is_cancelled", "is_refund_or_return",
    "dq_global_order_id_is_null", "dq_order_id_is_null", "dq_order_created_at_is_null",
    "dq_order_total_is_null", "dq_order_total_is_negative", "dq_currency_invalid_format",
    "dq_shipping_country_invalid_format", "dq_has_issue",
)


def _not(flag: str) -> Column:
    return ~F.coalesce(F.col(flag), F.lit(False))


def revenue_eligible() -> Column:
    """Not test, not cancelled, not refunded/returned (NULL flags count as
    false), with a present, non-negative total.  Never NULL."""
    total = F.col("order_total_num")
    return (_not("is_test_order") & _not("is_cancelled") & _not("is_refund_or_return")
            & total.isNotNull() & (total >= 0))


def revenue_rule(df: DataFrame) -> DataFrame:
    """``is_revenue_eligible`` and ``revenue_amount`` (the total, else 0)."""
    eligible = revenue_eligible()
    return df.withColumns({
        "is_revenue_eligible": eligible,
        "revenue_amount": F.when(eligible, F.col("order_total_num")).otherwise(F.lit(0).cast("decimal(38,9)")),
    })


def fact_orders(canonical: DataFrame) -> DataFrame:
    """One row per order: 46 carried columns + the revenue rule."""
    guard = F.col("rn").isNull() | (F.col("rn") == 1)
    return canonical.where(guard).select(*FACT_CARRIED).transform(revenue_rule)


ORDER, CUSTOMER = "global_order_id", "global_customer_id"


def _exact_counts(fact: DataFrame, keys: tuple[str, ...], sums: dict[str, Column], orders: str, customers: str) -> DataFrame:
    """Per ``keys``: the sums, and exact distinct counts of orders and customers,
    where both may repeat, without the ``Expand`` of several distinct counts
    (which copies every row once for each of them).

    Key-level stages instead, each combined on the map side: one row per key,
    order and customer with partial sums; of an order's rows the first stands
    for it; then one row per key and customer; then one per key.  An order id
    that very many customers share is sorted with spill, and rows without an
    order id need no such mark and are spread by customer.
    """
    per_pair = fact.groupBy(*keys, ORDER, CUSTOMER).agg(*(e.alias(n) for n, e in sums.items()))
    alike = Window.partitionBy(*keys, ORDER, F.when(F.col(ORDER).isNull(), F.xxhash64(CUSTOMER))).orderBy(CUSTOMER)
    stands = F.col(ORDER).isNotNull() & (F.row_number().over(alike) == 1)
    again = [F.sum(n).alias(n) for n in sums]
    per_customer = per_pair.withColumn(orders, stands.cast("bigint")).groupBy(*keys, CUSTOMER).agg(*again, F.sum(orders).alias(orders))
    return per_customer.groupBy(*keys).agg(*again, F.sum(orders).alias(orders), F.count(CUSTOMER).alias(customers))


def _grouped(fact: DataFrame, keys: tuple[str, ...], sums: dict[str, Column], orders: str, customers: str, orders_unique: bool) -> DataFrame:
    """After dedupe each non-NULL ``global_order_id`` occurs once, so the exact
    distinct count equals the non-NULL count and one distinct count is left, which
    needs no ``Expand``.  Only a caller that has deduplicated may say so."""
    if not orders_unique:
        return _exact_counts(fact, keys, sums, orders, customers)
    return fact.groupBy(*keys).agg(*(e.alias(n) for n, e in sums.items()), F.count(ORDER).alias(orders), F.count_distinct(CUSTOMER).alias(customers))


def _revenue_sums() -> dict[str, Column]:
    return {"orders_revenue_eligible": count_true(F.col("is_revenue_eligible")), "revenue": F.sum("revenue_amount")}


def _aov() -> Column:
    return safe_ratio(F.col("revenue"), F.col("orders_revenue_eligible")).alias("aov")


def kpi_daily_currency(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Per order_date x source_system x currency_canon."""
    keys = ("order_date", "source_system", "currency_canon")
    flagged = {n: count_true(F.coalesce(F.col(c), F.lit(False))) for n, c in (("cancelled_orders", "is_cancelled"), ("refunded_or_returned_orders", "is_refund_or_return"), ("n_issues", "dq_has_issue"))}
    g = _grouped(fact, keys, {"rows_in_fact": F.count(F.lit(1)), **_revenue_sums(), **flagged}, "orders_total", "customers_total", orders_unique)
    return g.select(*keys, "rows_in_fact", "orders_total", "customers_total", "orders_revenue_eligible", "revenue", _aov(),
                    "cancelled_orders", "refunded_or_returned_orders", safe_ratio(F.col("n_issues"), F.col("rows_in_fact")).alias("dq_issue_rate"))


def kpi_country_daily(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Per order_date x source_system x shipping_country_canon x currency_canon."""
    keys = ("order_date", "source_system", "shipping_country_canon", "currency_canon")
    g = _grouped(fact, keys, _revenue_sums(), "orders_total", "customers_total", orders_unique)
    return g.select(*keys, "orders_total", "customers_total", "orders_revenue_eligible", "revenue", _aov())


def kpi_status_daily(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Per order_date x source_system x order_status_canon."""
    keys = ("order_date", "source_system", "order_status_canon")
    g = _grouped(fact, keys, {"revenue_eligible_only": F.sum("revenue_amount")}, "orders", "customers", orders_unique)
    return g.select(*keys, "orders", "customers", "revenue_eligible_only")


# --- customer dimension ---------------------------------------------------

CUSTOMER_KEYS = ("global_customer_id", "source_system")


def customer_base(fact: DataFrame) -> DataFrame:
    """Orders with a customer key, pruned to what the dimension reads."""
    return fact.where(F.col("global_customer_id").isNotNull()).select(
        *CUSTOMER_KEYS, "email", "currency_canon", "order_date", "is_revenue_eligible", "revenue_amount")


def _eligible_date() -> Column:
    return F.when(F.col("is_revenue_eligible"), F.col("order_date"))


def customer_lifetime(fact: DataFrame) -> DataFrame:
    """P23: first/last dates (any and eligible), eligible orders, revenue.
    ``any_value(email)`` is taken as the smallest email: a legal, stable choice."""
    return customer_base(fact).groupBy(*CUSTOMER_KEYS).agg(
        F.min("email").alias("any_email"),
        F.min("order_date").alias("first_order_date_any"),
        F.max("order_date").alias("last_order_date_any"),
        F.min(_eligible_date()).alias("first_order_date_revenue_eligible"),
        F.max(_eligible_date()).alias("last_order_date_revenue_eligible"),
        count_true(F.col("is_revenue_eligible")).alias("lifetime_orders_revenue_eligible"),
        F.sum("revenue_amount").alias("lifetime_revenue"),
    )


def currency_counts(fact: DataFrame) -> DataFrame:
    """P24: eligible orders per customer x source x currency (NULL currency
    is its own group)."""
    return customer_base(fact).groupBy(*CUSTOMER_KEYS, "currency_canon").agg(
        count_true(F.col("is_revenue_eligible")).alias("eligible_orders_in_currency"))


def _most_used_currency(n: Column, currency: Column) -> Column:
    """The currency with most eligible orders; ties go to the smallest code
    and a NULL currency sorts first.  Rows with no eligible order carry a
    NULL ordering, which ``min_by`` skips."""
    return F.min_by(currency, F.when(n > 0, F.struct(-n, currency)))


def primary_currency(counts: DataFrame) -> DataFrame:
    """P25: one row per customer with at least one eligible order: the
    currency with most eligible orders, ties to the smallest code, NULL
    first.  A top-1 window over the (small) per-currency counts; the filter
    on ``rn`` lets Catalyst limit each group to one row before the shuffle.
    :func:`dim_customers` gets the same answer from ``min_by`` inside its
    aggregation."""
    n = F.col("eligible_orders_in_currency")
    w = Window.partitionBy(*CUSTOMER_KEYS).orderBy(n.desc(), F.col("currency_canon").asc_nulls_first())
    return (counts.where(n > 0)
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") == 1)
            .select(*CUSTOMER_KEYS, F.col("currency_canon").alias("primary_currency"), n))


def multi_currency(counts: DataFrame) -> DataFrame:
    """P26: number of currencies with an eligible order (0 if none)."""
    return counts.groupBy(*CUSTOMER_KEYS).agg(
        count_true(F.col("eligible_orders_in_currency") > 0).alias("num_currencies_used"))


def _recency(df: DataFrame, as_of) -> DataFrame:
    return df.withColumns({
        "is_multi_currency_customer": F.col("num_currencies_used") > 1,
        "days_since_last_order_any": day_diff(as_of_col(as_of), F.col("last_order_date_any")),
    })


DIM_COLUMNS = (
    "global_customer_id", "source_system", "any_email", "first_order_date_any", "last_order_date_any",
    "first_order_date_revenue_eligible", "last_order_date_revenue_eligible",
    "lifetime_orders_revenue_eligible", "lifetime_revenue", "primary_currency", "num_currencies_used",
    "is_multi_currency_customer", "days_since_last_order_any",
)


def _per_email(fact: DataFrame) -> DataFrame:
    """Customer x source x currency x email, over the fact rows: fixed-width metrics only."""
    return customer_base(fact).groupBy(*CUSTOMER_KEYS, "currency_canon", "email").agg(
        F.min("order_date").alias("first_any"),
        F.max("order_date").alias("last_any"),
        F.min(_eligible_date()).alias("first_elig"),
        F.max(_eligible_date()).alias("last_elig"),
        count_true(F.col("is_revenue_eligible")).alias("n"),
        F.sum("revenue_amount").alias("revenue"),
    )


def dim_customers(fact: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """P27 without joins, in three aggregation levels.

    1. customer x source x currency x email, over the fact rows: only counts,
       sums and date bounds, all fixed-width, so Spark runs it as a
       HashAggregate with map-side combine.  Email is a grouping key here
       rather than a ``min`` (a string aggregation buffer would force a
       sort-based aggregate over the whole fact).
    2. customer x source x currency, over the level-1 rows (small): the
       eligible-order count per currency and the smallest email.
    3. customer x source: lifetime metrics, the primary currency via
       ``min_by`` and the number of currencies used.

    Three exchanges, the last two over aggregated rows, against
    three branches and two joins in :func:`dim_customers_joined`.
    """
    per_currency = _per_email(fact).groupBy(*CUSTOMER_KEYS, "currency_canon").agg(
        F.min("email").alias("email"),
        F.min("first_any").alias("first_any"),
        F.max("last_any").alias("last_any"),
        F.min("first_elig").alias("first_elig"),
        F.max("last_elig").alias("last_elig"),
        F.sum("n").alias("n"),
        F.sum("revenue").alias("revenue"),
    )
    n = F.col("n")
    per_customer = per_currency.groupBy(*CUSTOMER_KEYS).agg(
        F.min("email").alias("any_email"),
        F.min("first_any").alias("first_order_date_any"),
        F.max("last_any").alias("last_order_date_any"),
        F.min("first_elig").alias("first_order_date_revenue_eligible"),
        F.max("last_elig").alias("last_order_date_revenue_eligible"),
        F.sum(n).alias("lifetime_orders_revenue_eligible"),
        F.sum("revenue").alias("lifetime_revenue"),
        _most_used_currency(n, F.col("currency_canon")).alias("primary_currency"),
        count_true(n > 0).alias("num_currencies_used"),
    )
    return _recency(per_customer, as_of).select(*DIM_COLUMNS)


def dim_customers_joined(fact: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """P27 with J01: the lifetime aggregate left-joined on both customer keys
    to the primary currency and the currency count.

    The three branches share one base: the fact's rows combined per customer,
    currency and email (so a hot customer is a few rows) and checkpointed to the
    shared folder, so whatever is behind the fact (the dedupe) runs once; without
    it each branch would prune its own columns and compute the fact for itself.
    The base is then dealt out once by the customer keys and checkpointed again,
    planned ahead (a plan that may change as it runs has no known partitioning):
    every branch and both joins work on these partitions in place.  A lost
    executor costs a read of the checkpoint.
    """
    spark = fact.sparkSession
    checkpoint_dir(spark)  # the shared folder must be known
    base = _per_email(fact).checkpoint()
    with planned_ahead(spark):
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        base = base.repartition(parts, *CUSTOMER_KEYS).checkpoint()
    lifetime = base.groupBy(*CUSTOMER_KEYS).agg(
        F.min("email").alias("any_email"),
        F.min("first_any").alias("first_order_date_any"),
        F.max("last_any").alias("last_order_date_any"),
        F.min("first_elig").alias("first_order_date_revenue_eligible"),
        F.max("last_elig").alias("last_order_date_revenue_eligible"),
        F.sum("n").alias("lifetime_orders_revenue_eligible"),
        F.sum("revenue").alias("lifetime_revenue"),
    )
    counts = base.groupBy(*CUSTOMER_KEYS, "currency_canon").agg(F.sum("n").alias("eligible_orders_in_currency"))
    joined = (lifetime
              .join(primary_currency(counts).drop("eligible_orders_in_currency"), list(CUSTOMER_KEYS), "left")
              .join(multi_currency(counts), list(CUSTOMER_KEYS), "left"))
    return _recency(joined, as_of).select(*DIM_COLUMNS)


def kpi_freshness_lag(fact: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Per ingest_date x source_system over the deduplicated fact: rows and
    orders loaded, average and maximum lag in days, rows later than 2 days."""
    lag = day_diff(F.col("ingest_date"), F.col("order_date"))
    late = count_true(lag > 2)
    n = F.count(F.lit(1))
    return (fact.where(F.col("ingest_date").isNotNull() & F.col("order_date").isNotNull())
            .groupBy("ingest_date", "source_system").agg(
                n.alias("rows_loaded"),
                (F.count(ORDER) if orders_unique else F.count_distinct(ORDER)).alias("orders_loaded"),
                F.avg(lag).alias("avg_lag_days"),
                F.max(lag).alias("max_lag_days"),
                late.alias("late_orders_gt_2d"),
                safe_ratio(late, n).alias("late_rate_gt_2d"),
            ))
