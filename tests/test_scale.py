"""Work a row and a table costs: compiled projections, folders listed once."""

from pyspark.sql import DataFrameReader

from fixtures import AS_OF, MARKETPLACE, STOREFRONT
from ordersmith.plans import pipeline
from ordersmith.plans.sinks import LAYOUTS, read_table, write_table
from ordersmith.session import scratch_path
from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW


def test_no_row_goes_through_a_method_too_long_to_be_compiled(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # bytes of bytecode, HotSpot's bound


def test_a_written_table_is_listed_once(spark, monkeypatch):
    m = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    fact = pipeline.fact(m, spark.createDataFrame(STOREFRONT, STOREFRONT_RAW), AS_OF)
    path, listed, parquet = scratch_path(spark, "fact"), [], DataFrameReader.parquet
    write_table(fact, path, LAYOUTS["mart_fact_orders"])
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **options: listed.append(paths) or parquet(self, *paths, **options))
    back = read_table(spark, path, fact.schema)
    assert listed == [(path,)]
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in fact.schema]
    assert back.exceptAll(fact).isEmpty() and fact.exceptAll(back).isEmpty()


def test_undated_rows_alone_come_back_with_the_declared_types(spark):
    m = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    fact = pipeline.fact(m, spark.createDataFrame(STOREFRONT, STOREFRONT_RAW), AS_OF)
    undated = fact.withColumn("order_date", fact["order_date"].substr(1, 0).try_cast("date"))  # every day is NULL
    path = scratch_path(spark, "fact")
    write_table(undated, path, LAYOUTS["mart_fact_orders"])
    back = read_table(spark, path, fact.schema)
    assert back.schema["order_date"].dataType == fact.schema["order_date"].dataType
    assert back.count() == fact.count() == back.where("order_date IS NULL").count()
