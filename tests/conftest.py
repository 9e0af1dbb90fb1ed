import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """DataFrame of raw texts; dicts are written as JSON."""
    def make(*records):
        texts = [(r if r is None or isinstance(r, str) else json.dumps(r),) for r in records]
        return spark.createDataFrame(texts, "value string")
    return make


def rows(df):
    """Rows as dicts, in a stable order."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda d: json.dumps(d, default=str))
