import pytest

from tests.llm import awkward


@pytest.fixture(scope="module")
def docs(spark):
    return awkward.table(spark)


@pytest.fixture(scope="module")
def no_docs(spark):
    return awkward.empty(spark)
