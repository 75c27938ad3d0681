"""The operators' queries against their SQL twins over whole tables."""

from __future__ import annotations

import pytest

from auditlake.llm.oracles import ORACLES
from auditlake.llm.queries import QUERIES
from conftest import SF_DIR
from oracle_check import connect, differences


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck.sql(ORACLES[name])) == []
