"""Hand-written CSV snapshots and the overwrite of written tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.plans.sinks import Layout, write_table
from ordersmith.sources.files import read_feed_csv

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("tags", T.StringType())])


def test_standard_quoting(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,tags\n1,"vip ""gold"" x"\n2,"a, ""b"""\n3,"ends in \\"\n4,"two\nlines"\n')
    got = {r["id"]: r["tags"] for r in read_feed_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()}
    assert got == {"1": 'vip "gold" x', "2": 'a, "b"', "3": "ends in \\", "4": "two\nlines"}


def test_zone_and_fraction_of_time_stamps(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.TimestampType())])
    (tmp_path / "a.csv").write_text("id,at\n1,2025-06-02 02:00:00.250000 UTC\n2,2025-06-02 02:00:00 UTC\n3,\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = read_feed_csv(spark, str(tmp_path), schema).select("id", F.unix_micros("at").alias("us")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {r["id"]: r["us"] for r in rows} == {"1": 1748829600250000, "2": 1748829600000000, "3": None}


def test_refresh_refuses_other_zones(spark, tmp_path):
    from fixtures import AS_OF, MARKETPLACE, STOREFRONT
    from ordersmith.plans import pipeline
    from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW

    m, s = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW), spark.createDataFrame(STOREFRONT, STOREFRONT_RAW)
    for key, value in (("spark.sql.session.timeZone", "America/Los_Angeles"), ("spark.sql.ansi.enabled", "false")):
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        try:
            with pytest.raises(ValueError, match=key):
                pipeline.full_refresh(spark, m, s, str(tmp_path), AS_OF)
        finally:
            spark.conf.set(key, before)


def test_nan_total_is_flagged(spark):
    from fixtures import AS_OF, MARKETPLACE
    from ordersmith.operators import stage_marketplace
    from ordersmith.sources.schema import MARKETPLACE_RAW

    raw = spark.createDataFrame(MARKETPLACE[:1], MARKETPLACE_RAW).withColumn("order_total", F.lit(float("nan")))
    row = stage_marketplace(raw, AS_OF).first()
    assert row["order_total_numeric"] is None and row["dq_order_total_is_null"]


def test_refresh_drops_stale_days(spark, tmp_path):
    path = str(tmp_path / "t")
    layout = Layout(date="day", cluster_by=("v",), day_directories=True)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("2025-01-01", "2025-01-02"):
            write_table(spark.range(3).select(F.lit(day).cast("date").alias("day"), F.col("id").alias("v")), path, layout)
        assert {str(r["day"]) for r in spark.read.parquet(path).select("day").distinct().collect()} == {"2025-01-02"}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
