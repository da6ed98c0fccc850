"""Sinks and sources: partitioned round trip, pruning, CSV snapshots."""

import os

from pyspark.sql import functions as F

from conftest import physical_plan
from fixtures import AS_OF, MARKETPLACE, STOREFRONT
from ordersmith.plans import pipeline
from ordersmith.plans.sinks import LAYOUTS, read_table, write_table
from ordersmith.session import scratch_path
from ordersmith.sources.files import read_feed_csv, read_feed_parquet, write_feed_csv
from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_partitioned_roundtrip_and_pruning(spark):
    import datetime as dt

    undated = (dt.datetime(2025, 6, 2, 8), "reports/2025-06-02.tsv", None, "A-ND", None, None, "Shipped", "AFN",
               5.0, "EUR", "DE", "b-nd")
    m = spark.createDataFrame(MARKETPLACE + [undated], MARKETPLACE_RAW)
    s = spark.createDataFrame(STOREFRONT, STOREFRONT_RAW)
    fact = pipeline.fact(m, s, AS_OF)
    assert fact.where("global_order_id = 'amazon:A-ND' AND order_date IS NULL").count() == 1
    path = scratch_path(spark, "fact")
    write_table(fact, path, LAYOUTS["mart_fact_orders"])
    assert any(d.startswith("order_date=") for d in os.listdir(path.replace("file:", "")))
    back = read_table(spark, path, fact.schema)
    assert back.columns == fact.columns
    assert same_rows(back, fact)  # the NULL date comes back from the default partition as NULL
    assert back.where("order_date IS NULL").count() == 1
    one_day = back.where(F.col("order_date") == F.lit("2025-06-01").cast("date"))
    plan = physical_plan(one_day)
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert one_day.count() == fact.where("order_date = DATE'2025-06-01'").count()


def test_mart_layout_is_date_ordered(spark):
    from conftest import SMALL
    from ordersmith import operators as op
    from ordersmith.sources.feeds import AS_OF as Q_AS_OF, feeds_from_dir

    fact = pipeline.fact(*feeds_from_dir(spark, SMALL), as_of=Q_AS_OF)
    kpi = op.kpi_daily_currency(fact)
    path = scratch_path(spark, "kpi")
    write_table(kpi, path, LAYOUTS["mart_kpi_orders_daily_currency"])
    files = [f for f in os.listdir(path.replace("file:", "")) if f.endswith(".parquet")]
    assert files and not any(d.startswith("order_date=") for d in os.listdir(path.replace("file:", "")))
    back = spark.read.parquet(path)
    assert same_rows(back.select(*kpi.columns), kpi)
    # each file holds one contiguous date range, in order
    ranges = (back.groupBy(F.input_file_name().alias("f"))
              .agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).orderBy("lo").collect())
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))
    one_day = back.where(F.col("order_date") == F.lit("2005-06-01").cast("date"))
    assert "PushedFilters: [IsNotNull(order_date), EqualTo(order_date" in \
        physical_plan(one_day)


def test_full_refresh_writes_every_table(spark):
    m = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    s = spark.createDataFrame(STOREFRONT, STOREFRONT_RAW)
    root = scratch_path(spark, "refresh")
    paths = pipeline.full_refresh(spark, m, s, root, AS_OF, write_staging=True, write_canonical=True)
    assert set(paths) == set(LAYOUTS)
    fact = pipeline.fact(m, s, AS_OF)
    for name, expected in pipeline.marts(fact, AS_OF).items():
        written = spark.read.parquet(paths[name]).select(*expected.columns)
        assert same_rows(written, expected), name
    assert spark.read.parquet(paths["mart_dim_customers"]).count() == 10


def test_csv_snapshot_roundtrip(spark):
    for rows, schema in ((MARKETPLACE, MARKETPLACE_RAW), (STOREFRONT, STOREFRONT_RAW)):
        df = spark.createDataFrame(rows, schema)
        path = scratch_path(spark, "csv")
        write_feed_csv(df, path)
        back = read_feed_csv(spark, path, schema, multi_line=True)  # a fixture value holds a line break
        assert same_rows(df, back)  # blanks stay blank, NULLs stay NULL, padding kept


def test_refresh_that_keeps_null_ids_reads_the_written_stack(spark):
    m = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    s = spark.createDataFrame(STOREFRONT, STOREFRONT_RAW)
    paths = pipeline.full_refresh(spark, m, s, scratch_path(spark, "refresh"), AS_OF, keep_null_ids=True)
    stack, fact = (spark.read.parquet(paths[t]) for t in ("int_amazon_shopify_orders", "mart_fact_orders"))
    assert same_rows(stack.select(*pipeline.stacked(m, s, AS_OF).columns), pipeline.stacked(m, s, AS_OF))
    expected = pipeline.fact(m, s, AS_OF, keep_null_ids=True)
    assert same_rows(fact.select(*expected.columns), expected)
    assert fact.where("global_order_id IS NULL").count() == stack.where("global_order_id IS NULL").count() > 1


def test_parquet_feed_in_any_column_order(spark):
    for rows, schema in ((MARKETPLACE, MARKETPLACE_RAW), (STOREFRONT, STOREFRONT_RAW)):
        df = spark.createDataFrame(rows, schema)
        path = scratch_path(spark, "parquet")
        df.select(*reversed(df.columns), F.lit(1).alias("extra")).write.parquet(path)
        back = read_feed_parquet(spark, path, schema)
        assert back.schema == schema and same_rows(df, back)
        assert read_feed_parquet(spark, path, schema).limit(0).count() == 0
