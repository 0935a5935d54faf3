import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from lakeward.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="lakeward-tests")
    yield s


@pytest.fixture(autouse=True, scope="module")
def uncached():
    """What one module caches does not stand in for the plans that a later one reads."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path)
