"""Every checked query against its SQL on the smallest data set; a few on data with hot keys."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
from tenura.plans import registry
from verify import compare, connect

QUERIES, ORACLES = registry.queries(), registry.oracles()       # optional parts have tests of their own
FITS = {"scan_k", "segment_customers", "segment_projection", "segment_profile_kmeans", "random_forest_baseline",
        "gradient_boosting_baseline", "mlp_baseline", "logistic_baseline", "cross_validate", "score_all",
        "model_permutation_importance", "logistic_coefficients", "save_model", "train_summary"}


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["contract_type", "internet_service"] and df.count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_every_query_without_sql_is_known():
    rows_only = {n for n in QUERIES if n not in ORACLES}
    assert rows_only <= FITS
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, data_dir, name):
    assert compare(QUERIES[name](spark, data_dir), con, ORACLES[name]) == ""


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory, data_dir):
    """A third of all orders belong to one customer, of all items to one order, and to one part."""
    folder = str(tmp_path_factory.mktemp("hot"))
    changes = {
        "customer": "SELECT * FROM t", "part": "SELECT * FROM t",
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM t",
        "lineitem": """SELECT * REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
                                         CASE WHEN l_suppkey % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey) FROM t""",
    }
    for name, text in changes.items():
        duckdb.sql(f"COPY (WITH t AS (SELECT * FROM '{data_dir}/{name}.parquet') {text}) "
                   f"TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ["snake_case_columns", "customer_360", "addon_impact", "high_value_at_risk",
                                  "stratified_split", "km_by_group", "model_comparison", "mann_whitney"])
def test_hot_keys(spark, hot_dir, name):
    assert compare(QUERIES[name](spark, hot_dir), connect(hot_dir), ORACLES[name]) == ""
