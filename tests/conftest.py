import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bazaarlens.session import local_session  # noqa: E402
from bazaarlens.sources.durable import release  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "bazaarlens-tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def tables(spark):
    from bazaarlens.sources.tables import open_star

    return open_star(spark, MEDIUM)
