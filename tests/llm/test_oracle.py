"""Queries that SQL can express, against DuckDB."""

import pytest

from rsvpflow.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


def test_names():
    assert set(ORACLE_SQL) <= set(QUERIES) and sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, SF_SMALL, [name], verbose=False)[name] == "OK"
