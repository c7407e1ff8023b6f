"""Every registered query against its SQL on the test tables, and the shape of the registry."""

import os
import re

import pytest

import __spark_entry__ as registry
from oracle import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TRAINED = {"cluster_business_types", "fit_stability", "predict_trends", "stability_report", "regression_metrics"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def link():
    return connect(FOLDER)


#: Queries of the optional subpackage have their own tests.
OWN = [name for name in registry.queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_registry():
    assert set(OWN) - set(registry.oracle_sql()) == TRAINED
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", ["opens_per_year", "apply_type_map", "type_to_cluster", "cache_fill", "error_metrics"])
def test_queries_are_lazy(spark, name):
    """Building a query runs no job but those that read the schema of a table's files."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        query = registry.queries()[name](spark, FOLDER)
        jobs = context.statusTracker().getJobIdsForGroup(name)
    finally:
        context.setJobGroup("tests", "tests")
    tables = query._jdf.queryExecution().logical().toString().count("Relation [")
    assert len(jobs) <= tables


@pytest.mark.parametrize("name, scans", [("predict_trends", 0), ("error_metrics", 1), ("future_grid", 0)])
def test_orders_are_read_once(spark, name, scans):
    """The final plan reads orders at most once; what is 0 here was read when the history was written."""
    plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") <= max(1, scans)


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) & set(OWN)))
def test_same_as_sql(spark, link, name):
    assert differences(registry.queries()[name](spark, FOLDER), link, registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_trained_queries_have_rows(spark, name):
    assert registry.queries()[name](spark, FOLDER).count() > 0
