"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The load steps (extract, mart, scores) run once and are reported by themselves. Every query runs
twice; `queries` holds the second run, `first_run` the first.
"""

import json
import os
import time

from tenura.plans import registry
from tenura.session import local_session
from tenura.sources.warehouse import Warehouse

HEADLINE = [
    "churn_by_contract", "revenue_at_risk", "tenure_cohorts", "addon_impact", "payment_billing", "high_value_at_risk",
    "model_risk_tiers", "customer_360", "feature_mart", "unpivot_addons", "pivot_addons", "spend_quartile",
    "validation_report", "check_domains", "check_relationship", "table_fingerprint", "kaplan_meier", "km_by_group",
    "logrank_test", "cramers_v", "mann_whitney", "spearman_matrix", "numeric_summary", "category_rates", "box_stats",
    "dimension_breakdown", "churn_decomposition", "kpi_summary", "stratified_split", "stratified_folds", "roc_auc",
    "average_precision", "calibration_table", "top_decile_lift", "cumulative_gains", "profit_curve",
    "model_comparison", "run_summary", "permutation_importance", "measures_base", "measures_compare",
    "measures_addons", "measures_scores", "campaign_what_if", "call_list", "segment_features", "segment_profile",
    "logistic_baseline",
]
# dear ones run once, as long as the time for them lasts; what was left out is listed
SLOW = ["segment_customers", "random_forest_baseline", "mlp_baseline", "scan_k", "gradient_boosting_baseline", "cross_validate"]
SLOW_SECONDS = float(os.environ.get("BENCH_SLOW_SECONDS", "420"))


def seconds(run) -> float:
    t = time.perf_counter()
    run()
    return round(time.perf_counter() - t, 3)


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    warehouse = Warehouse.open(spark, data_dir)
    load = {name: seconds(getattr(warehouse, name)) for name in ("raw", "mart", "split_cuts", "scored")}
    queries = registry.queries()
    first, warm = {}, {}
    for name in HEADLINE:
        def run():
            queries[name](spark, data_dir).write.format("noop").mode("overwrite").save()
        first[name] = seconds(run)
        warm[name] = seconds(run)
    began, once, skipped = time.perf_counter(), {}, []
    for name in SLOW:
        if time.perf_counter() - began > SLOW_SECONDS:
            skipped.append(name)
            continue
        once[name] = seconds(lambda: queries[name](spark, data_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds_warm", "value": round(sum(warm.values()), 2), "unit": "sec", "queries": warm,
        "sf": os.path.basename(data_dir.rstrip("/")), "first_run": first, "load": load, "run_once": once, "not_run": skipped, "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}))


if __name__ == "__main__":
    main()
