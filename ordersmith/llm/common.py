"""Shared helpers: reading the tables, hold-out rules, written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersmith.session import checkpoint_dir


_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Let the executors' Python import this package: where PYTHONPATH does not
    name its folder, Spark sends it to them as a zip file (``addPyFile``)."""
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if root not in paths and app not in _SHIPPED:
        to = Path(tempfile.mkdtemp(prefix="ordersmith-code-")) / "ordersmith.zip"  # the driver's copy, which Spark serves
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted((root / "ordersmith").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(to))
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null: empty) alone, so that no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id's decimal text, modulo ``of`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read again, which
    cuts its lineage: a lost executor costs a file read, not a recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs inside hand at most ``rows`` rows at once to Python: the JVM's copy of a batch
    (grown by doubling) and the worker's both lie outside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Ids (8 bytes each) that may be sent to every task, at most.
SENT = 2_000_000


def sendable(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked to go to every task if their count allows.  The
    join of a larger one deals both sides out by id and hashes the ids of a
    partition, so that the texts on the other side are neither sorted nor spilled."""
    return F.broadcast(ids) if ids.count() <= SENT else ids.hint("shuffle_hash")
