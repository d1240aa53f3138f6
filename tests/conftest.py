import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to a list of texts and return the values."""
    from pyspark.sql import functions as F

    def run(values, function):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(2)
        return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
