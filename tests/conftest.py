import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barflow.session import local_session

    session = local_session("barflow-tests", cores=os.environ.get("TEST_CPUS", "4"), shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def tick_series(spark, small):
    """All events as one price series per symbol: few symbols, many rows each."""
    from pyspark.sql import functions as F

    e = spark.read.parquet(f"{small}/events.parquet")
    return e.select(
        F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("id"),
        F.col("value").alias("Close"), (F.col("event_id") + 1).alias("Volume"),
    ).cache()
