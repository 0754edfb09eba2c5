import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("newslens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session

    from newslens.sources import workspace

    workspace.clean_up(session)
    session.stop()


@pytest.fixture
def articles(spark):
    """Articles from (title, content, date) tuples; dates as text or None."""
    from newslens import clean

    def make(*rows):
        data = [("s", t, f"u{i}", c, d) for i, (t, c, d) in enumerate(rows)]
        schema = "source string, title string, link string, content string, published_date string"
        return clean.with_dates(spark.createDataFrame(data, schema))

    return make
