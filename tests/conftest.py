import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tamarack.session import local_session, ship

    session = local_session(4, partitions=4)
    session.conf.set("spark.sql.ansi.enabled", "true")
    ship(session)
    yield session


@pytest.fixture(scope="session")
def data():
    return os.environ.get("TAMARACK_TEST_DATA", "/root/testdata/sf0.001")
