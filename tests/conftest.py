import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [_HERE, os.path.dirname(_HERE)]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidewell.workspace import apply_settings

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidewell-wh-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    apply_settings(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tidewell-test-")
