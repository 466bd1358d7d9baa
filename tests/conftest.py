import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from recordbridge.session import tune

    session = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def make(spark):
    """Small frame from rows and a schema text."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def rows():
    """Rows of a frame, in no particular order, as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
