"""The whole pipeline as composed DataFrame plans.

``stacked`` -> ``canonical`` -> ``fact`` are lazy plans; the staging and
integration steps are narrow and collapse into one projection per feed, so
the first shuffle is the dedupe window.  :func:`full_refresh` writes each
table once and builds the five marts from the *written* fact, so the fact
is computed once (not five times), lineage is cut at a durable table, and a
lost executor costs a re-read of files rather than a recompute from raw.
All tables of a refresh become visible in one step (``versions``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import (
    canonical_orders,
    dim_customers,
    fact_orders,
    kpi_country_daily,
    kpi_daily_currency,
    kpi_freshness_lag,
    kpi_status_daily,
    stack_orders,
    stage_marketplace,
    stage_storefront,
    unify_marketplace,
    unify_storefront,
)
from ..operators.canonical import add_customer_key, dedupe_latest, standardize
from ..session import remove, require, scratch_path, shuffles_freed
from . import versions
from .sinks import COMPRESSION, LAYOUTS, PIECE, PIECES, Narrow, in_pieces, piece_by, pieces_of, read_table, write_table

AsOf = _dt.date | str | None


def stacked(raw_marketplace: DataFrame, raw_storefront: DataFrame, as_of: AsOf = None) -> DataFrame:
    """stg_* -> int_amazon_shopify_orders (narrow: no shuffle)."""
    return stack_orders(unify_marketplace(stage_marketplace(raw_marketplace, as_of)),
                        unify_storefront(stage_storefront(raw_storefront, as_of)))


def canonical(raw_marketplace: DataFrame, raw_storefront: DataFrame, as_of: AsOf = None,
              keep_null_ids: bool = False) -> DataFrame:
    return canonical_orders(stacked(raw_marketplace, raw_storefront, as_of), keep_null_ids=keep_null_ids)


def fact(raw_marketplace: DataFrame, raw_storefront: DataFrame, as_of: AsOf = None,
         keep_null_ids: bool = False) -> DataFrame:
    return fact_orders(canonical(raw_marketplace, raw_storefront, as_of, keep_null_ids=keep_null_ids))


@contextmanager
def latest_orders(stack: DataFrame, keep_null_ids: bool = False, most: int = 2) -> Iterator[Narrow]:
    """The latest row of each order (:func:`dedupe_latest`) with its canonical columns
    still to come, in a scratch folder that goes at the end: what is written from it is
    deduplicated once.  Orders are deduplicated in ``most`` pieces by their id, so the
    shuffle holds one piece at a time (each reads ``stack`` again), and lie in folders
    of more pieces by their date, which are read once each."""
    spark, path = stack.sparkSession, scratch_path(stack.sparkSession, "latest_orders")
    by_date = 2 * pieces_of(stack) - 1
    try:
        with shuffles_freed(spark):
            for k, part in enumerate(in_pieces(stack, "global_order_id", pieces_of(stack, most))):
                latest = dedupe_latest(part, keep_null_ids=keep_null_ids)
                latest.withColumn(PIECE, piece_by("order_date", by_date)).write.partitionBy(PIECE).parquet(f"{path}/ids={k}", compression=COMPRESSION)
        rows = spark.read.schema(T.StructType([*latest.schema.fields, T.StructField(PIECE, T.IntegerType())])).parquet(path)
        yield Narrow(rows.select(*latest.columns, PIECE), standardize, by_date)
    finally:
        remove(spark, path)


def keyed_fact(orders: Narrow) -> Narrow:
    """The fact of :func:`latest_orders`: rows with the columns of its layout."""
    return Narrow(add_customer_key(orders.rows), lambda rows: fact_orders(orders.finish(rows)), orders.pieces)


def marts(fact_df: DataFrame, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The five marts of one fact (one row per order), keyed by table name."""
    return {
        "mart_kpi_orders_daily_currency": kpi_daily_currency(fact_df, orders_unique=True),
        "mart_kpi_orders_country_daily_currency": kpi_country_daily(fact_df, orders_unique=True),
        "mart_kpi_orders_status_daily": kpi_status_daily(fact_df, orders_unique=True),
        "mart_dim_customers": dim_customers(fact_df, as_of),
        "mart_kpi_freshness_lag": kpi_freshness_lag(fact_df, orders_unique=True),
    }


def full_refresh(spark: SparkSession, raw_marketplace: DataFrame, raw_storefront: DataFrame,
                 root: str, as_of: AsOf = None, write_staging: bool = True,
                 write_canonical: bool = True, keep_null_ids: bool = False) -> dict[str, str]:
    """Rebuild the ten tables under ``root`` (a shared folder) and publish them
    together; returns the paths of the new versions.

    Each table is written to a fresh folder and read back by the steps after it,
    so a raw feed is scanned for one table alone (for a large one, once a piece: see
    ``sinks``) and a lost executor costs a file read.  Readers
    (:func:`ordersmith.plans.versions.open_table`) keep the old tables until
    all new ones are written, then see all new ones.  At scale staging, the
    stacked table and the canonical table are each another full copy of the order
    data: ``write_staging=False`` leaves out the first three, ``write_canonical=False``
    the last, and neither changes the others.  Refuses a session that is not set to
    UTC and ANSI; a missing ``as_of`` is today, resolved once for all tables.
    """
    require(spark)
    if as_of is None:
        as_of = spark.sql("SELECT current_date() AS today").first()["today"]
    paths: dict[str, str] = {}

    def put(df: DataFrame | Narrow, name: str) -> None:
        paths[name] = versions.fresh_path(root, name)
        write_table(df, paths[name], LAYOUTS[name])

    def landed(df: DataFrame | Narrow, name: str) -> DataFrame:
        put(df, name)
        return read_table(spark, paths[name], df.schema)

    def staged(raw: DataFrame, stage, name: str) -> DataFrame:
        rows = stage(raw, as_of)
        if not write_staging:
            return rows
        keyed = rows.select(*dict.fromkeys((*raw.columns, LAYOUTS[name].date)))  # a staged table has the raw columns as they are
        return landed(Narrow(keyed, lambda dealt: stage(dealt.select(*raw.columns), as_of)), name)

    m = staged(raw_marketplace, stage_marketplace, "stg_amazon_orders")
    s = staged(raw_storefront, stage_storefront, "stg_shopify_orders")
    stack = stack_orders(unify_marketplace(m), unify_storefront(s))
    if write_staging:
        stack = landed(stack, "int_amazon_shopify_orders")
    with latest_orders(stack, keep_null_ids, most=PIECES if write_staging else 2) as orders:
        if write_canonical:
            put(orders, "int_orders_canonical")
        else:
            fact_back = landed(keyed_fact(orders), "mart_fact_orders")
    if write_canonical:
        canon = read_table(spark, paths["int_orders_canonical"], orders.schema)
        fact_back = landed(Narrow(canon, fact_orders), "mart_fact_orders")
    for name, df in marts(fact_back, as_of).items():
        put(df, name)
    versions.publish(spark, root, paths)
    return paths
