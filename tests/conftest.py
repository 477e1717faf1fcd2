import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.session import JOB_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        **JOB_CONF,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-warehouse-"),
    }
    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    """All tables, empty, in a database of their own."""
    from tidemark.plans.suite import workspace
    from tidemark.schemas import ALL_TABLES

    return workspace(spark, *ALL_TABLES)[0]
