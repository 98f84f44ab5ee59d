"""Queries of this subpackage against their SQL twins."""

from __future__ import annotations

import pytest

from barloom.llm.queries import llm_queries, llm_sql
from tests.compare import connect, differences
from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_its_twin(spark, database, name):
    assert differences(llm_queries()[name](spark, SMALL), database.sql(llm_sql()[name])) is None
