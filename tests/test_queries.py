"""Every registered traffic query against its SQL twin, and the driver's entry points."""

import pytest

import __spark_entry__
from roadpulse.plans.oracle import ORACLE_SQL
from roadpulse.plans.queries import QUERIES

from .compare import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    columns, want = duck_rows(ORACLE_SQL[name], SF)
    assert sorted(df.columns) == columns
    assert spark_rows(df) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    assert "DSH" in __spark_entry__.entry(spark).columns
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_one_shuffle_by_journey(spark):
    plan = QUERIES["trip_segments"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(journey_id") == 1 and plan.count("Exchange") == 1
    assert "Python" not in plan


def test_measures_scan_the_observations_once(spark):
    for name in ("link_moe_5min", "link_moe_hourly", "corridor_moe_5min"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet [event_id") == 1, name
        assert plan.count("Exchange hashpartitioning(journey_id") == 1, name
