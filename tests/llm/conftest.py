import pytest

from sitefold.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)
    return spark
