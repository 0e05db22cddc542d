"""Every registered plan with an SQL form agrees with DuckDB (sf0.001);
plans without one run and return rows."""

import pytest

from kestrel.plans import all_plans
from tests.conftest import SF001

PLANS = all_plans()


@pytest.fixture(scope="module")
def con():
    from tests.oracle import duck
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(n for n, p in PLANS.items() if p.sql))
def test_plan_matches_duckdb(spark, con, name):
    from tests.oracle import compare
    ok, msg = compare(spark, SF001, name, PLANS[name].fn, PLANS[name].sql, con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(n for n, p in PLANS.items() if not p.sql))
def test_plan_without_sql_runs(spark, name):
    assert PLANS[name].fn(spark, SF001).count() >= 1


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
