import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="marketlens-test-ckpt-", dir="/tmp")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("marketlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def warehouse(spark):
    from marketlens.plans.pipeline import Warehouse

    return Warehouse.from_testbed(spark, SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="marketlens-test-", dir="/tmp")
