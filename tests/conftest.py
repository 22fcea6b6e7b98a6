from __future__ import annotations

import tempfile

import pytest

from tests.session import local_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(**{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def medium() -> str:
    return MEDIUM


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("job"))
