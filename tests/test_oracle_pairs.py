"""Every registered query against its DuckDB oracle at sf0.001, floats bit for bit (sf0.01: tools.check_oracle)."""

import pytest

import __spark_entry__ as E
from skewsafe.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.compare import same_result

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    same, why = same_result(df, duck_small, E.oracle_sql()[name], exact=True)
    assert same, why


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
