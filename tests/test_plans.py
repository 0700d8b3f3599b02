"""Properties of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from tenura.plans import registry
from tenura.sources.warehouse import Warehouse
from tenura.sources import snapshot

QUERIES = registry.queries()
QUESTIONS = ["churn_by_contract", "tenure_cohorts", "addon_impact", "payment_billing", "kpi_summary", "measures_base",
             "category_rates", "dimension_breakdown"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUESTIONS)
def test_questions_scan_aggregate_and_nothing_else(spark, data_dir, name):
    text = plan(QUERIES[name](spark, data_dir))
    for bad in ("Cartesian", "NestedLoop", "SortMergeJoin", "Python", "Generate"):
        assert bad not in text, bad
    assert "partial_" in text                                   # map-side combine


def test_columns_are_pruned(spark, data_dir):
    text = plan(QUERIES["churn_by_contract"](spark, data_dir))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",") if ":" in c} == \
        {"contract_type", "internet_service", "monthly_charges", "churn"}


def test_first_orders_are_limited_before_the_shuffle(spark, data_dir):
    w = Warehouse.open(spark, data_dir)
    text = plan(snapshot.order_history(w.source("orders")))
    assert text.count("WindowGroupLimit") == 2                  # before and after the exchange


def test_split_assignment_does_not_shuffle_customers(spark, data_dir):
    w = Warehouse.open(spark, data_dir)
    from tenura.functions.domain import SplitSizes
    from tenura.operators import split
    text = plan(split.assign_split(w.mart(), "customer_id", "churn", w.split_cuts(), SplitSizes()))
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_a_hot_part_is_split(spark, tmp_path):
    """With the part table too large to broadcast, AQE splits the partition of a part holding a third
    of all items (thresholds scaled down to the test data)."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5KB", "spark.sql.shuffle.partitions": "50",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in small}
    data, items = "/root/testdata/sf0.01", str(tmp_path / "items")
    spark.read.parquet(f"{data}/lineitem.parquet").select(
        "l_orderkey", F.when(F.col("l_suppkey") % 3 == 0, 11).otherwise(F.col("l_partkey")).cast("bigint").alias("l_partkey")) \
        .repartition(20).write.parquet(items)
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = snapshot.addon_items(spark.read.parquet(f"{data}/orders.parquet"), spark.read.parquet(items),
                                  spark.read.parquet(f"{data}/part.parquet"))
        total = sum(sum(r[1:]) for r in df.collect())
        final = plan(df).split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true) [l_partkey" in final
    assert total == spark.read.parquet(items).count()


def test_no_shuffle_of_customers_on_few_valued_keys(spark, data_dir):
    """With a small broadcast limit the written side tables are still broadcast by their real size."""
    from tenura.operators import star, stats

    w = Warehouse.open(spark, data_dir)
    c360, peers, ranks = w.customer_360(), w.peer_prices(), w.tenure_ranks()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
    try:
        for df in (star.price_vs_peers(c360, peers), star.tenure_pct_in_contract(c360, ranks)):
            text = plan(df)
            assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text
        few = stats.spearman_matrix(w.mart(), ["churn", "tenure", "n_addons"])
        assert "SortMergeJoin" not in plan(few)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
