"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from velotide.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert r["ok"], r


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date_key", "full_date", "member_casual", "trip_count", "total_duration_minutes"]
