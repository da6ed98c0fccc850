"""The staging layer on a streaming source equals batch staging."""

from fixtures import AS_OF, MARKETPLACE
from ordersmith import operators as op
from ordersmith.session import scratch_path
from ordersmith.sources.files import write_feed_csv
from ordersmith.sources.schema import MARKETPLACE_RAW
from ordersmith.streaming import land_staged, stage_feed_stream


def test_stream_staging_matches_batch(spark):
    raw = spark.createDataFrame(MARKETPLACE, MARKETPLACE_RAW)
    landing = scratch_path(spark, "landing")
    write_feed_csv(raw, landing)
    staged = stage_feed_stream(spark, landing, "marketplace", AS_OF, multi_line=True)
    assert staged.isStreaming
    table, ckpt = scratch_path(spark, "stg_stream"), scratch_path(spark, "stg_stream_ckpt")
    q = land_staged(staged, table, ckpt)
    q.awaitTermination(120)
    batch = op.stage_marketplace(raw, AS_OF)
    got = spark.read.parquet(table).select(*batch.columns)
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
