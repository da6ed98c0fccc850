"""Schema contracts and malformed CSV rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, MARKETPLACE
from ordersmith import operators as op
from ordersmith.plans.sinks import LAYOUTS, read_table, write_table
from ordersmith.session import scratch_path
from ordersmith.sources.contract import SchemaDrift, check_files
from ordersmith.sources.files import load_feed_csv, read_feed_csv, read_feed_parquet, write_feed_csv
from ordersmith.sources.schema import MARKETPLACE_RAW
from ordersmith.streaming import stage_feed_stream

DRIFT = {
    "missing": (lambda df: df.drop("currency"), "column currency .string. is missing"),
    "renamed": (lambda df: df.withColumnRenamed("currency", "ccy"), "column currency .string. is missing"),
    "retyped": (lambda df: df.withColumn("order_total", F.col("order_total").cast("string")), "order_total is string, declared double"),
    "narrowed": (lambda df: df.withColumn("purchase_date", F.to_date("purchase_date")), "purchase_date is date, declared timestamp"),
}


@pytest.mark.parametrize("kind", DRIFT)
def test_feed_drift_is_an_error(spark, kind):
    change, message = DRIFT[kind]
    path = scratch_path(spark, "drift")
    change(spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)).write.parquet(path)
    with pytest.raises(SchemaDrift, match=message):
        read_feed_parquet(spark, path, MARKETPLACE_RAW)


@pytest.mark.parametrize("kind", [*DRIFT, "extra"])
def test_table_drift_is_an_error(spark, kind):
    change, message = {**DRIFT, "extra": (lambda df: df.withColumn("more", F.lit(1)), "column more .int. is not declared")}[kind]
    path = scratch_path(spark, "drift")
    staged = op.stage_marketplace(spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW), AS_OF)
    write_table(change(staged), path, LAYOUTS["stg_amazon_orders"])
    with pytest.raises(SchemaDrift, match=message):
        read_table(spark, path, staged.schema)


def test_partition_column_that_is_gone_is_an_error(spark):
    path = scratch_path(spark, "drift")
    staged = op.stage_marketplace(spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW), AS_OF)
    staged.drop("ingest_date").write.parquet(path)
    with pytest.raises(SchemaDrift, match="column ingest_date"):
        read_table(spark, path, staged.schema)


def test_files_that_disagree(spark):
    path = scratch_path(spark, "drift")
    df = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    df.coalesce(1).write.parquet(path)
    df.coalesce(1).withColumn("order_total", F.lit("x")).write.mode("append").parquet(path)
    with pytest.raises(SchemaDrift, match="disagree"):
        check_files(spark, path, MARKETPLACE_RAW, every_file=True)


def test_empty_table_reads_back(spark):
    path = scratch_path(spark, "empty")
    staged = op.stage_marketplace(spark.createDataFrame([], MARKETPLACE_RAW), AS_OF)
    write_table(staged, path, LAYOUTS["stg_amazon_orders"])
    assert read_table(spark, path, staged.schema).count() == 0


LINES = [
    "2025-06-02 08:00:00.000000 UTC,f.tsv,2025-06-01,G-1,2025-06-01 10:00:00 UTC,,Shipped,AFN,10.5,EUR,DE,b1",
    "2025-06-02 08:00:00.000000 UTC,f.tsv,2025-06-01,B-NUM,2025-06-01 10:00:00 UTC,,Shipped,AFN,ten,EUR,DE,b2",
    "2025-06-02 08:00:00.000000 UTC,f.tsv,2025-06-01,B-TIME,yesterday,,Shipped,AFN,7,EUR,DE,b3",
    "2025-06-02 08:00:00.000000 UTC,f.tsv,2025-06-01,B-SHORT,2025-06-01 10:00:00 UTC",
    "2025-06-02 08:00:00.000000 UTC,f.tsv,2025-06-01,B-LONG,2025-06-01 10:00:00 UTC,,Shipped,AFN,8,EUR,DE,b5,more,fields",
    "2025-06-02 08:00:00.000000 UTC,f.tsv,01/06/2025,B-DATE,2025-06-01 10:00:00 UTC,,Shipped,AFN,9,EUR,DE,b6",
    '2025-06-02 08:00:00.000000 UTC,f.tsv,2025-06-01,G-2,2025-06-01 10:00:00 UTC,,"Shipped, ""late""",AFN,11,"",DE,b7',
]


@pytest.fixture
def dirty(spark):
    path = scratch_path(spark, "dirty")
    spark.createDataFrame([(",".join(MARKETPLACE_RAW.fieldNames()),), *((x,) for x in LINES)], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_rows_are_flagged_and_kept(spark, dirty):
    raw = load_feed_csv(spark, dirty, MARKETPLACE_RAW)
    rows = {r["amazon_order_id"]: r for r in raw.collect()}
    assert len(rows) == len(LINES)
    assert {k for k, r in rows.items() if r["dq_row_is_malformed"]} == {"B-NUM", "B-TIME", "B-SHORT", "B-LONG", "B-DATE"}
    assert rows["B-NUM"]["order_total"] is None and rows["B-NUM"]["buyer_id"] == "b2" and rows["B-NUM"]["malformed_line"] == LINES[1]
    assert rows["B-TIME"]["purchase_date"] is None and rows["B-TIME"]["order_total"] == 7.0
    assert rows["B-SHORT"]["purchase_date"] == dt.datetime(2025, 6, 1, 10) and rows["B-SHORT"]["currency"] is None
    assert rows["B-DATE"]["report_date"] is None and rows["B-DATE"]["order_total"] == 9.0
    assert rows["B-LONG"]["buyer_id"] == "b5" and rows["B-LONG"]["malformed_line"] == LINES[4]
    assert rows["G-2"]["order_status"] == 'Shipped, "late"' and rows["G-2"]["currency"] == "" and rows["G-2"]["malformed_line"] is None
    # the flag is the same when a query reads few columns
    few = {r[0]: r[1] for r in raw.select("amazon_order_id", "dq_row_is_malformed").collect()}
    assert few == {k: r["dq_row_is_malformed"] for k, r in rows.items()}
    assert raw.where("dq_row_is_malformed").count() == 5
    with pytest.raises(Exception):  # the strict reader still refuses such a file
        read_feed_csv(spark, dirty, MARKETPLACE_RAW).collect()


def test_flag_flows_through_staging_and_stops_at_the_unified_columns(spark, dirty):
    staged = op.stage_marketplace(load_feed_csv(spark, dirty, MARKETPLACE_RAW), AS_OF)
    assert staged.where("dq_row_is_malformed and dq_order_total_is_null").count() == 2  # bad number, short row
    assert "dq_row_is_malformed" not in op.unify_marketplace(staged).columns
    assert op.unify_marketplace(staged).count() == len(LINES)


def test_good_snapshot_has_no_flag(spark):
    path = scratch_path(spark, "good")
    df = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    write_feed_csv(df, path)
    raw = load_feed_csv(spark, path, MARKETPLACE_RAW, multi_line=True)
    assert raw.where("dq_row_is_malformed").count() == 0
    assert raw.select(*df.columns).exceptAll(df).isEmpty() and raw.count() == df.count()


def test_stream_can_flag(spark, dirty):
    name = "flagged_stream"
    q = stage_feed_stream(spark, dirty, "marketplace", AS_OF, flag_malformed=True).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table(name).where("dq_row_is_malformed").count() == 5 and spark.table(name).count() == len(LINES)
