"""Every survey query against its DuckDB equivalent."""

import pytest

from surveyloom.plans.survey_queries import ORACLES, QUERIES
from tests.conftest import same_as_oracle


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, sf_dir, name):
    same_as_oracle(spark, duck, sf_dir, name, QUERIES[name], ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
