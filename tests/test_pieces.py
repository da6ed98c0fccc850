"""Disk of a write: shuffles that go with it, few columns dealt out, large tables in pieces."""

import os
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from fixtures import AS_OF, MARKETPLACE, STOREFRONT
from ordersmith import operators as op
from ordersmith.plans import pipeline, sinks
from ordersmith.plans.sinks import LAYOUTS, read_table, write_table
from ordersmith.session import scratch_path
from ordersmith.sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW

ORDER_GRAIN = [t for t, layout in LAYOUTS.items() if layout.date and layout.day_directories]


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def feeds(spark):
    """Feeds in files, whose size is known: the fixture's rows, rows that come again, blank ids, days and a NULL one."""
    undated = MARKETPLACE[0][:3] + ("A-ND", None) + MARKETPLACE[0][5:]
    blank = MARKETPLACE[0][:3] + (" ", *MARKETPLACE[0][4:])
    m = spark.createDataFrame(MARKETPLACE + [undated, blank, blank, *MARKETPLACE[:2]], MARKETPLACE_RAW)
    days = spark.range(60).select(F.col("id").cast("int").alias("n"))
    many = m.limit(1).crossJoin(days).withColumns({
        "amazon_order_id": F.concat(F.lit(" M-"), (F.col("n") % 40).cast("string")),
        "purchase_date": F.col("purchase_date") + F.make_interval(days=F.col("n") % 20),
        "last_updated_date": F.col("purchase_date") + F.make_interval(days=F.col("n"))}).drop("n")
    path = scratch_path(spark, "feeds")
    m.unionByName(many).write.parquet(f"{path}/m")
    spark.createDataFrame(STOREFRONT + STOREFRONT[:1], STOREFRONT_RAW).write.parquet(f"{path}/s")
    return spark.read.parquet(f"{path}/m"), spark.read.parquet(f"{path}/s")


@pytest.fixture
def in_pieces(monkeypatch):
    monkeypatch.setattr(sinks, "PIECE_BYTES", 1)


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (blocks.apply(i).getName() for i in range(blocks.size())) if n.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write_that_made_them(spark, feeds):
    before, key = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    fact = pipeline.fact(*feeds, as_of=AS_OF)
    write_table(fact, scratch_path(spark, "fact"), LAYOUTS["mart_fact_orders"])
    until = time.time() + 20  # they are deleted in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(key, None) == was


def test_a_large_table_is_written_in_pieces_of_whole_days(spark, feeds, in_pieces, monkeypatch):
    stack = pipeline.stacked(*feeds, AS_OF)
    write, modes, path = DataFrameWriter.mode, [], scratch_path(spark, "stack")
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, mode: modes.extend([mode] if mode else []) or write(self, mode))
    write_table(stack, path, LAYOUTS["int_amazon_shopify_orders"])
    assert modes == ["overwrite"] + ["append"] * (sinks.PIECES - 1)
    assert same_rows(read_table(spark, path, stack.schema), stack)
    jobs = {d: {f.split("-", 2)[2].split(".")[0] for f in os.listdir(f"{path.replace('file:', '')}/{d}") if f.startswith("part-")}
            for d in os.listdir(path.replace("file:", "")) if d.startswith("order_date=")}
    assert len(jobs) > 15 and all(len(j) == 1 for j in jobs.values())  # a day is one piece's
    assert len(set.union(*jobs.values())) > 1
    write_table(stack.limit(3), path, LAYOUTS["int_amazon_shopify_orders"])  # the first piece replaces all days
    assert read_table(spark, path, stack.schema).count() == 3


@pytest.mark.parametrize("keep_null_ids", [False, True])
def test_orders_deduplicated_in_pieces_are_the_same(spark, feeds, in_pieces, keep_null_ids):
    stack = pipeline.stacked(*feeds, AS_OF)
    with pipeline.latest_orders(stack, keep_null_ids) as orders:
        place = orders.rows.select(F.input_file_name().alias("f")).distinct().collect()
        assert len({r["f"].split("/ids=")[1][0] for r in place}) == 2 and orders.pieces > sinks.PIECES
        canon = pipeline.canonical(*feeds, AS_OF, keep_null_ids=keep_null_ids)
        assert same_rows(orders.finish(orders.rows.drop(sinks.PIECE)), canon)
        assert canon.where("global_order_id IS NULL").count() == (7 if keep_null_ids else 1)
        scratch = place[0]["f"].split("/ids=")[0].replace("file://", "")
        assert os.path.isdir(scratch)
    assert not os.path.exists(scratch)


def test_the_scratch_folder_goes_when_a_write_fails(spark, feeds):
    stack = pipeline.stacked(*feeds, AS_OF)
    with pytest.raises(OSError), pipeline.latest_orders(stack) as orders:
        scratch = orders.rows.select(F.input_file_name().alias("f")).first()["f"].split("/ids=")[0].replace("file://", "")
        raise OSError
    assert not os.path.exists(scratch)


@pytest.mark.parametrize("keep_null_ids", [False, True])
def test_a_refresh_in_pieces_writes_the_same_tables(spark, feeds, in_pieces, keep_null_ids, monkeypatch):
    m, s = feeds
    write, dealt = pipeline.write_table, {}
    monkeypatch.setattr(pipeline, "write_table", lambda df, path, layout: dealt.update({path.split("/")[-2]: df}) or write(df, path, layout))
    paths = pipeline.full_refresh(spark, m, s, scratch_path(spark, "refresh"), AS_OF, keep_null_ids=keep_null_ids)
    stack = pipeline.stacked(m, s, AS_OF)
    canon = op.canonical_orders(stack, keep_null_ids=keep_null_ids)
    expected = {"stg_amazon_orders": op.stage_marketplace(m, AS_OF), "stg_shopify_orders": op.stage_storefront(s, AS_OF),
                "int_amazon_shopify_orders": stack, "int_orders_canonical": canon, "mart_fact_orders": op.fact_orders(canon)}
    assert set(expected) == set(ORDER_GRAIN)
    for name, df in expected.items():
        assert same_rows(read_table(spark, paths[name], df.schema), df), name
    # staging deals out the raw columns and the date, the canonical table the unified ones
    assert dealt["stg_amazon_orders"].rows.columns == [*m.columns, "ingest_date"]
    assert dealt["stg_shopify_orders"].rows.columns == [*s.columns, "order_date"]
    assert dealt["int_orders_canonical"].rows.columns == [*stack.columns, "rn", sinks.PIECE]
    fewer = pipeline.full_refresh(spark, m, s, scratch_path(spark, "refresh"), AS_OF, False, False, keep_null_ids)
    assert len(fewer) == 6
    assert same_rows(read_table(spark, fewer["mart_fact_orders"], expected["mart_fact_orders"].schema), expected["mart_fact_orders"])
