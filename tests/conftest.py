import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from sluice.session import configure
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sluice-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture(scope="session")
def registry(spark):
    from sluice.plans.queries import corpus_registry
    return corpus_registry(spark, with_fixtures=True).cache()


def envelopes(spark, rows):
    """rows: (key, schemaURI, data) -> envelope frame with a ``k`` column."""
    import datetime as dt
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    return spark.createDataFrame(
        [(k, "t-topic", u, ts, d) for k, u, d in rows],
        "k string, origin string, schemaURI string, timestamp timestamp, data string")
