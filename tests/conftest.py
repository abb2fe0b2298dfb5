import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidelog.session import RECOMMENDED_CONF  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "8")
        # tests run locally: databases without a location go to a fresh
        # temporary warehouse, not the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidelog-wh-"))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    # tests run without a cluster: a private shared folder
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidelog-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df) -> list[tuple]:
    """Rows as tuples in a NULL-safe total order."""
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple((v is not None, str(v)) for v in t))
