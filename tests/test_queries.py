from __future__ import annotations

import os

import pytest

import finloom.plans  # noqa: F401
import finloom.streaming  # noqa: F401
from finloom.plans.catalog import QUERIES, SQL
from tests.conftest import SMALL as _SMALL
from tests.oracle import connect, differences

#: Tables to run on; the driver compares at sf0.01.
SMALL = os.environ.get("QUERY_SF_DIR", _SMALL)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert differences(con, df, SQL[name]) == []
    else:
        assert df.count() > 0
