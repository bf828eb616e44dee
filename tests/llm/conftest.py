import pytest


@pytest.fixture(scope="module")
def spark_holder(spark):
    """The session for property tests, which want no function-scoped fixtures."""
    return spark
