"""Queries on tables in which one key holds a third of the rows."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracle

SOURCE = "/root/testdata/sf0.001"
HEAVY = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id)",
    "lineitem": "* REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey)",
}
NAMES = [
    "accounts_latest", "consumer_parity", "credit_features", "ecom_countries", "format_parity",
    "iot_sensors", "merge_accounts", "merge_late_changes", "scores_latest", "score_gaps",
    "stream_merge_accounts", "top_risk",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    with duckdb.connect() as con:
        for path in glob.glob(f"{SOURCE}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            columns = HEAVY.get(name, "*")
            con.execute(f"COPY (SELECT {columns} FROM '{path}') TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_a_heavy_key(spark, skewed, name):
    df = entry.queries()[name](spark, skewed)
    assert oracle.compare(df, oracle.connect(skewed), entry.oracle_sql()[name]) == []
