import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from ordersmith.session import configure

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder; a cluster names a shared one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    configure(s)
    yield s
    s.stop()


def physical_plan(df) -> str:
    """The physical plan text from the public ``explain`` output."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(extended=True)
    return buf.getvalue().split("== Physical Plan ==", 1)[1]
