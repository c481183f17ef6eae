import pytest

from dwellspan.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, same):
    same(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["coverage_ledger", "asof_join", "point_in_range_join", "anti_band_join", "interval_overlap_join", "coverage_payload"])
def test_time_joins_have_no_nested_loops(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
