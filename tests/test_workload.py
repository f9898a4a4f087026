"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, database

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    assert compare(spark, db, SF, name) == ""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["hour", "nb_interventions", "travel_time"]


@pytest.mark.parametrize("name", ["volume_vs_speed", "resource_consumption", "stress_test", "pca_eigen_lines"])
def test_scans_are_pruned(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
