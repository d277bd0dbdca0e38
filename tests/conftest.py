import functools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellamp.plans import queries  # noqa: E402
from cellamp.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def shared_runs():
    """Let all queries of the session read the same stored tables."""
    original = queries._run

    @functools.cache
    def cached(spark, sf_dir, config, params):
        return original(spark, sf_dir, config, params)

    queries._run = lambda spark, sf_dir, config=queries.fixture.LINEAR, params=queries.PARAMS: cached(
        spark, sf_dir, config, params
    )
    yield
    queries._run = original
