"""A selection of registered queries against their SQL twins on the smallest tables.

``python tests/oracle.py 0.01`` compares all of them.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
CHECKED = ("allocate_units", "exact_match", "compliance_kpis", "launch_pivot_dashboard", "attribute_diff",
           "cohort_unmatched_configured_customers_regionalized", "weekly_demand_stats", "lag_features")


def test_registry_is_consistent():
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries) and len(queries) > 80
    assert all(callable(q) for q in queries.values())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_twin(spark, name):
    assert compare(entry.queries()[name](spark, ROOT), connect(ROOT), entry.oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "config_string" and df.count() > 0
