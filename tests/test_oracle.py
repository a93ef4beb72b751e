"""Every registered query against its DuckDB oracle (rows, columns, values) at sf0.001."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import compare

from __spark_entry__ import oracle_sql
from rsvpflow.plans.queries import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_oracle():
    missing = set(QUERIES) - set(oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res == "OK", res


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["role", "region", "total_invited", "registered", "positive_responses",
                          "total_confirmed", "unregistered", "registration_rate"]
    assert df.count() > 0
