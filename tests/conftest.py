import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]")
               .appName("leadscope-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.driver.memory", "4g")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from leadscope.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="leadscope-test-")


def as_parquet(spark, rows, schema, scratch):
    """Small fixtures go through Parquet so expressions run in codegen, not constant folding."""
    path = tempfile.mkdtemp(prefix="fx-", dir=scratch)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
