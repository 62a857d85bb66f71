"""Every registered query against its SQL twin on the smallest test tables."""

import os

import pytest
from compare import compare, duck

from tallyframe.catalog import REGISTRY, Tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, REGISTRY[name], Tables) == []
