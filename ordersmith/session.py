"""Session settings the pipeline relies on, and the shared checkpoint folder.

On a cluster the session is created by the platform; :func:`configure` sets
what results depend on and fills in the rest where it is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on: UTC dates and ANSI casts.
RESULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# The runtime re-planning that the plans are written for (AQE coalescing and skew splitting).
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot never compiles a method of over 8,000 bytes of bytecode.  The staging
    # projections generate such a one, whose rows would be interpreted; beyond this
    # limit Spark evaluates operator by operator, in methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RESULTS.items():
        spark.conf.set(k, v)
    for k, v in PLANNING.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def require(spark: SparkSession) -> None:
    """Refuse a session whose settings would change results without an error."""
    wrong = {k: spark.conf.get(k, None) for k, v in RESULTS.items() if (spark.conf.get(k, None) or "").lower() != v.lower()}
    if wrong:
        raise ValueError(f"call ordersmith.session.configure(spark) first; these settings differ from what results depend on: {wrong}")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ordersmith") -> SparkSession:
    """A local session for tests and the bench (Spark UI off)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", os.environ.get("ORDERSMITH_DRIVER_MEMORY", "8g"))
             .config("spark.sql.session.timeZone", "UTC")
             # One machine: list partition folders on the driver rather
             # than in a distributed listing job (a cluster keeps the default).
             .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
             # PySpark records the Python call site of every column operation
             # for error messages, several JVM round trips each; plan building
             # is faster without (a static setting: only at session start).
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the platform (a shared filesystem every
    executor can reach), and it is an error if it is not.  Only in local mode
    a folder of our own is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        d = tempfile.mkdtemp(prefix="ordersmith-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


@contextmanager
def planned_ahead(spark: SparkSession) -> Iterator[None]:
    """Jobs inside keep the plan they start with (no adaptive changes)."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write that ends inside go as it ends.  Else they stay
    until the driver happens to collect its garbage, so one write's files would lie
    beside those of the next.  A write's plan is its own: nobody reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate, in whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediates."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
