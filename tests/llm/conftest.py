import pytest

from orefold.llm.common import on_workers


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)
