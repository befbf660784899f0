import pytest
from llm_data import LABELS, SCHEMA, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, None, None), (None, 1, 1), (6, 0, 1), (6, 0, 1)], LABELS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)
