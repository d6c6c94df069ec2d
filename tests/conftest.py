import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from tidemark.session import local_session, new_dir  # noqa: E402
from tidemark.streaming.tables import ReplicationTables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8, "8g")
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    return ReplicationTables(new_dir(spark, "test"))


@pytest.fixture
def folder():
    return SMALL
