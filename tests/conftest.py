from __future__ import annotations

import pytest

from retinue.session import local_session
from tests.oracle import connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8, 4, spark__checkpoint__dir=shared, spark__sql__warehouse__dir=shared + "/warehouse"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SF_DIR)
