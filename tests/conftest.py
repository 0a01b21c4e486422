"""One small session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
DATA = Path(os.environ.get("LUMBRERA_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lumbrera.plans.lineage import ship

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test tables here")
    return str(DATA / "sf0.001")
