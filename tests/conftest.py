import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    from pitwise.plans.session import local_session

    s = local_session("*", shuffle_partitions=8, app="pitwise-tests")
    yield s


def frame(spark: SparkSession, schema: str, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, schema=schema)
