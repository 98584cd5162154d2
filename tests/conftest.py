import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, in the given or their own order."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
