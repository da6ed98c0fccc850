"""Staging on a streaming source.

The reference rebuilds every table in batch; it has no watermark, window or
state.  What carries over to a stream is the staging layer: it is a narrow,
row-by-row projection (clean, map, flag), so the same operator runs
unchanged on a ``readStream`` source.  Dedupe and the marts stay batch
steps over the landed data (``plans.pipeline``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import stage_marketplace, stage_storefront
from ..sources.files import csv_read_options, flagged, with_line
from ..sources.schema import MARKETPLACE_RAW, STOREFRONT_RAW

_FEEDS = {
    "marketplace": (MARKETPLACE_RAW, stage_marketplace),
    "storefront": (STOREFRONT_RAW, stage_storefront),
}


def stage_feed_stream(spark: SparkSession, path: str, feed: str,
                      as_of: _dt.date | str | None = None, multi_line: bool = False,
                      flag_malformed: bool = False) -> DataFrame:
    """A streaming DataFrame of staged rows for CSV files landing in ``path``
    (``multi_line`` as in :func:`ordersmith.sources.files.read_feed_csv`).  A
    malformed row ends the stream, or is flagged as by ``load_feed_csv``."""
    schema, stage = _FEEDS[feed]
    reader = spark.readStream.options(**csv_read_options(multi_line, flag_malformed))
    if flag_malformed:
        return stage(flagged(reader.schema(with_line(schema)).csv(path)), as_of)
    return stage(reader.schema(schema).csv(path), as_of)


def land_staged(staged: DataFrame, table_path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append staged rows to a Parquet table; the checkpoint (in the shared
    folder) makes restarts exactly-once per file."""
    writer = (staged.writeStream.format("parquet").outputMode("append")
              .option("path", table_path).option("checkpointLocation", checkpoint))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
