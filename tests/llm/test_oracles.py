from __future__ import annotations

import pytest
from tests.conftest import SMALL
from tests.oracle import connect, differences

from finloom.llm.oracles import oracle_sql
from finloom.llm.queries import queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    assert differences(connect(SMALL), queries()[name](spark, SMALL), oracle_sql()[name]) == []
