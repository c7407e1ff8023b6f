"""Queries that SQL can express, against their SQL on the test tables."""

import os

import pytest
from oracle import connect, differences

from permitry.llm import queries

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    assert differences(queries.queries()[name](spark, FOLDER), connect(FOLDER), queries.oracle_sql()[name]) is None
