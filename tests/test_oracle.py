"""Every registered query against its DuckDB statement (the driver's gate)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import duck, frames_equal  # noqa: E402

from conftest import SF01  # noqa: E402

from thermograph.plans.catalog import ORACLE_SQL as SQL  # noqa: E402
from thermograph.plans.catalog import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    # The entry has them all; the corpus operators' keys have tests of their own.
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF01).toPandas()
    want = con.sql(SQL[name]).df()
    ok, msg = frames_equal(got, want)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 241  # neighborhood-days with both day and night rows at sf0.001
    assert df.columns == ["day", "neighborhood", "day_temp", "day_hum", "night_temp",
                          "night_hum", "temp_diff", "hum_diff"]


SCALE_SENSITIVE = sorted(k for k in QUERIES if k.startswith("moving_avg_") or k.endswith("_transitions")
                         or k in ("actuator_events", "actuator_state"))


@pytest.fixture(params=["halo", "prefix"])
def large_plans(spark, request):
    """Force the plans meant for large inputs on sf0.01: treated as large, and
    with a row target of 1 for prefix (every key looks hot: 1-hour buckets)."""
    spark.conf.set("spark.thermograph.smallInputBytes", "0")
    if request.param == "prefix":
        spark.conf.set("spark.thermograph.bucketRows", "1")
    yield
    spark.conf.unset("spark.thermograph.smallInputBytes")
    spark.conf.unset("spark.thermograph.bucketRows")


@pytest.mark.parametrize("name", SCALE_SENSITIVE)
def test_large_input_plans_match_sql(spark, con, large_plans, name):
    got = QUERIES[name](spark, SF01).toPandas()
    ok, msg = frames_equal(got, con.sql(SQL[name]).df())
    assert ok, msg
