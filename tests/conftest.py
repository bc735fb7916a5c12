import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tests-"))
         .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def table(spark):
    """A DataFrame of text columns from tuples."""
    def make(columns, data, schema=None):
        names = columns.split()
        return spark.createDataFrame(data, schema or ", ".join(f"{n} string" for n in names))
    return make
