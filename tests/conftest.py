import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwork.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Result of an expression over one text column, in input order."""

    def run(expression, inputs):
        df = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]

    return run
