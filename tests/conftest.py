from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.01"
# writes cost per day and class, not per row
SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("auditlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")
        # many small plans: compile them fast rather than well
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def small_dir():
    return SMALL_DIR
