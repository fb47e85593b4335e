"""Every registered query against DuckDB on the small tables, and the driver contract."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from flowlake.checks.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# No SQL gives a fitted model.
ROWS_ONLY = {"credit_model", "model_report", "credit_tiers_trained"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.compare(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_contract(spark):
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() == 4
    assert df.columns == ["revenue_bucket", "order_count", "revenue", "avg_order_value", "bucket_rank"]


@pytest.mark.parametrize("name", ["ecom_buckets", "derive_iot", "credit_features", "merge_accounts"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
