import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "2")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
