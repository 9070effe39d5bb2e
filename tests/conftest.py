import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("boxweave-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from boxweave.runtime import tune

    yield tune(session)
    session.stop()


@pytest.fixture
def hot(monkeypatch):
    """Treats every key with more than a tenth of the rows as hot."""
    from boxweave import runtime
    from boxweave.operators import components

    monkeypatch.setattr(runtime, "HOT_FLOOR", 0)
    monkeypatch.setattr(components, "HOT_FLOOR", 0)
    monkeypatch.setattr(runtime, "HOT_KEYS", 10)
