"""Grouped tables: the seven business questions, exploratory tables and report tables.

Every one is a scan, a partial aggregation on the map side, and a tiny final aggregation. Windows
run over aggregated rows (label combinations), never over customers.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.functions.numeric import half_up, mean_of, ratio, share_pct
from tenura.operators.ordering import exact_percentiles, join_same, ntile
from tenura.session import written_table



def _lost(amount: str = "monthly_charges") -> Column:
    return F.sum(F.when(F.col("churn") == 1, F.col(amount)).otherwise(F.lit(0).cast(D.MONEY)))


def churn_by_contract(c360: DataFrame) -> DataFrame:
    """Churn and revenue per contract and internet product."""
    return c360.groupBy("contract_type", "internet_service").agg(
        F.count("*").alias("customers"),
        F.sum("churn").alias("churned"),
        share_pct(F.sum("churn"), F.count("*")).alias("churn_rate_pct"),
        half_up(mean_of(F.col("monthly_charges")), 2).alias("avg_monthly_charge"),
        F.sum("monthly_charges").cast("double").alias("mrr"),
        _lost().cast("double").alias("mrr_lost"),
    ).orderBy(F.desc("churn_rate_pct"), "contract_type", "internet_service")


def revenue_at_risk(c360: DataFrame) -> DataFrame:
    """Lost revenue per contract and payment method with share, running share and rank."""
    per = c360.groupBy(F.concat_ws(" / ", "contract_type", "payment_method").alias("segment")).agg(
        F.sum("churn").alias("churned"), _lost().alias("lost"))
    every = Window.partitionBy(F.lit(0))            # label combinations only
    ranked = every.orderBy(F.desc("lost"))
    running = every.orderBy(F.desc("lost"), "segment").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(
        "segment", "churned", F.col("lost").cast("double").alias("mrr_lost"),
        share_pct(F.col("lost"), F.sum("lost").over(every)).alias("pct_of_total_loss"),
        share_pct(F.sum("lost").over(running), F.sum("lost").over(every)).alias("cumulative_pct"),
        F.rank().over(ranked).alias("loss_rank"),
    ).orderBy("loss_rank", "segment")


def tenure_cohorts(c360: DataFrame) -> DataFrame:
    monthly = F.count_if(F.col("contract_type") == "Month-to-month")
    return c360.groupBy("tenure_band").agg(
        F.min("tenure").alias("min_tenure"),
        F.count("*").alias("customers"),
        share_pct(F.sum("churn"), F.count("*")).alias("churn_rate_pct"),
        half_up(mean_of(F.col("monthly_charges")), 2).alias("avg_monthly_charge"),
        half_up(mean_of(F.col("n_services")), 2).alias("avg_services"),
        share_pct(monthly, F.count("*"), 1).alias("pct_month_to_month"),
    ).orderBy("min_tenure")


def _with_without(status: str = "status") -> tuple[Column, Column]:
    """Churn rate with and without a service; other statuses take no part in either mean."""
    with_it, without = F.col(status) == "Yes", F.col(status) == "No"
    churn = F.col("churn")
    return (ratio(F.sum(F.when(with_it, churn)), F.count_if(with_it)),
            ratio(F.sum(F.when(without, churn)), F.count_if(without)))


def tall_addons(wide: DataFrame, *keep: str) -> DataFrame:
    """One row per customer and add-on with the kept columns. Unpivoting the wide frame is a
    projection; joining the long bridge back to the customers would shuffle six rows for each."""
    return wide.select(*keep, *D.ADDONS).unpivot(list(keep), D.ADDONS, "service_name", "status")


def addon_impact(wide: DataFrame) -> DataFrame:
    """Per add-on, internet customers only: churn with and without it, gap, adopters."""
    tall = tall_addons(wide.where(F.col("internet_service") != "No"), "churn")
    with_rate, without_rate = _with_without()
    adopters = F.count_if(F.col("status") == "Yes")
    return tall.groupBy("service_name").agg(
        with_rate.alias("w"), without_rate.alias("wo"), adopters.alias("adopters"),
        share_pct(adopters, F.count("*"), 1).alias("adoption_pct"),
    ).select(
        "service_name", half_up(100.0 * F.col("w"), 2).alias("churn_with_pct"),
        half_up(100.0 * F.col("wo"), 2).alias("churn_without_pct"),
        half_up(100.0 * F.col("wo") - 100.0 * F.col("w"), 2).alias("churn_gap_pts"),
        "adopters", "adoption_pct",
    ).orderBy(F.desc("churn_gap_pts"), "service_name")


def addon_effect(wide: DataFrame) -> DataFrame:
    """Unrounded rates with and without each add-on, internet customers only."""
    tall = tall_addons(wide.where(F.col("internet_service") != "No"), "churn")
    with_rate, without_rate = _with_without()
    return tall.groupBy(F.replace("service_name", F.lit("_"), F.lit(" ")).alias("service")).agg(
        with_rate.alias("with_addon"), without_rate.alias("without_addon")).orderBy("without_addon", "service")


def payment_billing(c360: DataFrame, min_customers: int = 50) -> DataFrame:
    billing = F.when(F.col("paperless_billing") == 1, "Paperless").otherwise("Paper")
    return c360.groupBy("payment_method", billing.alias("billing")).agg(
        F.count("*").alias("customers"),
        share_pct(F.sum("churn"), F.count("*")).alias("churn_rate_pct"),
        half_up(mean_of(F.col("tenure")), 1).alias("avg_tenure"),
    ).where(F.col("customers") >= min_customers).orderBy(F.desc("churn_rate_pct"), "payment_method", "billing")


def high_value_at_risk(c360: DataFrame) -> DataFrame:
    """Customers in the top spend quartile by contract and product, and what their churn costs a year."""
    narrow = c360.select("customer_id", "contract_type", "internet_service", "churn", "monthly_charges")
    top = ntile(narrow, "customer_id", 4, "spend_quartile", value="monthly_charges") \
        .where(F.col("spend_quartile") == 4)
    return top.groupBy("contract_type", "internet_service").agg(
        F.count("*").alias("top_quartile_customers"),
        F.sum("churn").alias("churned"),
        share_pct(F.sum("churn"), F.count("*")).alias("churn_rate_pct"),
        half_up(_lost() * 12, 0).alias("annualised_revenue_lost"),
    ).orderBy(F.desc("annualised_revenue_lost"), "contract_type", "internet_service")


def model_risk_tiers(scores: DataFrame, c360: DataFrame) -> DataFrame:
    """Predicted and actual churn per model and tier."""
    joined = scores.select("customer_id", "model_name", "risk_tier", "churn_probability").join(
        c360.select("customer_id", "churn", "monthly_charges"), "customer_id")
    return joined.groupBy("model_name", "risk_tier").agg(
        F.count("*").alias("customers"),
        half_up(mean_of(F.col("churn_probability").cast("decimal(9,5)")), 3).alias("avg_predicted"),
        half_up(mean_of(F.col("churn")), 3).alias("actual_rate"),
        F.sum("monthly_charges").cast("double").alias("mrr_in_tier"),
    ).orderBy("model_name", F.desc("avg_predicted"))


# ---------------------------------------------------------------- exploratory tables
def category_rates(df: DataFrame, features: list[str], target: str = "churn") -> DataFrame:
    """Rate and size per level of several features: one scan, one group-by."""
    tall = df.select(target, *[F.col(c).cast("string").alias(c) for c in features]) \
        .unpivot([target], features, "feature", "level")
    return tall.groupBy("feature", "level").agg(
        half_up(mean_of(F.col(target)), 3).alias("rate"), F.count("*").alias("n"))


def target_balance(df: DataFrame, target: str = "churn") -> DataFrame:
    total = Window.partitionBy(F.lit(0))             # one row per class
    return df.groupBy(F.when(F.col(target) == 1, "churned").otherwise("retained").alias("outcome")).agg(
        F.count("*").alias("n")).select("outcome", ratio(F.col("n"), F.sum("n").over(total)).alias("share"))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max per column.

    Deviation comes from sums of decimals with six digits, so it does not depend on row order; extremes
    and quartiles are those of the values themselves. Quartiles come from value counts: nothing keeps all
    values of a column in one task.
    """
    tall = df.select([F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot([], columns, "feature", "value").where(F.col("value").isNotNull())
    v = F.col("value").cast("decimal(20,6)")
    moments = tall.groupBy("feature").agg(
        F.count("*").alias("cnt"), F.sum(v).cast("double").alias("s"),
        F.sum((v * v).cast("decimal(38,6)")).cast("double").alias("ss"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quarts = exact_percentiles(tall, ["feature"], "value", [0.25, 0.5, 0.75]).drop("n")
    n, s, ss = F.col("cnt"), F.col("s"), F.col("ss")
    return moments.join(quarts, "feature").select(
        "feature", n.alias("count"), half_up(s / n, 2).alias("mean"),
        half_up(F.sqrt(F.greatest(ratio(ss - s * s / n, n - 1), F.lit(0.0))), 2).alias("std"),
        half_up("min", 2).alias("min"), half_up("p25", 2).alias("p25"), half_up("p50", 2).alias("p50"),
        half_up("p75", 2).alias("p75"), half_up("max", 2).alias("max"))


def rate_pivot(c360: DataFrame, row: str = "contract_type", column: str = "internet_service",
               levels=tuple(D.RAW_DOMAINS["InternetService"])) -> DataFrame:
    """Matrix of mean outcome and size; the pivot levels are given."""
    return c360.groupBy(row).pivot(column, list(levels)).agg(
        mean_of(F.col("churn")).alias("rate"), F.count("churn").alias("n")).select(
        row, *[F.col(f"`{v}_rate`").alias(f"rate_{v.split()[0].lower()}") for v in levels],
        *[F.col(f"`{v}_n`").alias(f"n_{v.split()[0].lower()}") for v in levels])


def rate_crosstab_by_quartile(tagged: DataFrame, labels: list[str], quartile: str = "price_quartile") -> DataFrame:
    """Mean outcome per contract and product, across the price quartiles."""
    return tagged.groupBy("contract_type", "internet_service").pivot(quartile, labels) \
        .agg(half_up(mean_of(F.col("churn")), 3))


def density_histogram(df: DataFrame, value: str, bins: int = 36, by: str = "churn") -> DataFrame:
    """Equal-width bins between the smallest and largest value of each class; densities add up to 1
    over the width of a class. The last bin includes the maximum."""
    rows = df.select(by, F.col(value).cast("double").alias("v"))
    edges = rows.groupBy(by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total")) \
        .withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    inside = F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("width")))
    binned = join_same(rows, written_table(df.sparkSession, edges), [by]).withColumn(
        "bin", F.least(F.coalesce(inside, F.lit(0)), F.lit(bins - 1)).cast("int"))
    return binned.groupBy(by, "bin").agg(
        F.count("*").alias("n"), F.max("lo").alias("lo"), F.max("width").alias("width"),
        F.max("total").alias("total")).select(
        by, "bin", half_up(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"), "n",
        half_up(F.try_divide(F.col("n").cast("double"), F.col("total") * F.col("width")), 6).alias("density"))


def charge_histogram(c360: DataFrame, width: float = 5.0) -> DataFrame:
    """Customers per charge step and status."""
    step = F.floor(F.col("monthly_charges").cast("double") / width).cast("double") * width
    return c360.groupBy(step.alias("charge_from"), X.status(F.col("churn")).alias("status")).agg(
        F.count("*").alias("customers"))


def box_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 interquartile ranges) per label group."""
    rows = df.select(*keys, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    box = exact_percentiles(rows, keys, "v", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = join_same(rows, written_table(df.sparkSession, box), keys)
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return fenced.groupBy(*keys).agg(
        F.max("n").alias("n"), *[half_up(F.max(c), 6).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


# ---------------------------------------------------------------- report tables
def kpi_summary(c360: DataFrame) -> DataFrame:
    left, stayed = F.col("churn") == 1, F.col("churn") == 0
    return c360.agg(
        F.count("*").alias("customers"), F.sum("churn").alias("churned"),
        mean_of(F.col("churn")).alias("churn_rate"),
        F.sum("monthly_charges").cast("double").alias("mrr"),
        _lost().cast("double").alias("mrr_lost"),
        F.coalesce(ratio(_lost(), F.sum("monthly_charges")), F.lit(0.0)).alias("mrr_lost_share"),
        ratio(F.sum(F.when(left, F.col("tenure"))), F.count_if(left)).alias("avg_tenure_churned"),
        ratio(F.sum(F.when(stayed, F.col("tenure"))), F.count_if(stayed)).alias("avg_tenure_retained"))


BREAKDOWN_LEVELS = {
    "contract_type": D.RAW_DOMAINS["Contract"],
    "internet_service": D.RAW_DOMAINS["InternetService"],
    "payment_method": D.RAW_DOMAINS["PaymentMethod"],
    "tenure_band": [label for label, _ in D.TENURE_BANDS],
}


def dimension_breakdown(c360: DataFrame, levels: dict[str, list[str]] = BREAKDOWN_LEVELS) -> DataFrame:
    """Totals per level of each field, levels without customers as zeros.

    Grouping sets count all fields in one pass over the customers.
    """
    fields = list(levels)
    sets = c360.groupingSets([[F.col(f)] for f in fields], *[F.col(f) for f in fields]).agg(
        F.grouping_id().alias("gid"), F.count("*").alias("customers"), F.sum("churn").alias("churned"),
        F.sum("monthly_charges").alias("mrr"), _lost().alias("mrr_lost"), F.sum("tenure").alias("months"))
    bit = {f: (2 ** len(fields) - 1) - 2 ** (len(fields) - 1 - i) for i, f in enumerate(fields)}
    field, level = F.lit(None).cast("string"), F.lit(None).cast("string")
    for f in fields:
        field = F.when(F.col("gid") == bit[f], F.lit(f)).otherwise(field)
        level = F.when(F.col("gid") == bit[f], F.col(f)).otherwise(level)
    found = sets.select(field.alias("field"), level.alias("level"), "customers", "churned", "mrr",
                        "mrr_lost", "months")
    wanted = c360.sparkSession.createDataFrame(
        [(f, v, i) for f, values in levels.items() for i, v in enumerate(values, 1)],
        "field string, level string, level_order int")
    per_field = Window.partitionBy("field")
    n = F.coalesce("customers", F.lit(0))
    return wanted.join(found, ["field", "level"], "left").select(
        "field", "level", "level_order", n.alias("customers"),
        F.coalesce("churned", F.lit(0)).alias("churned"),
        F.coalesce(ratio(F.col("churned"), n), F.lit(0.0)).alias("churn_rate"),
        F.coalesce(F.col("mrr").cast("double"), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.col("mrr_lost").cast("double"), F.lit(0.0)).alias("mrr_lost"),
        F.coalesce(ratio(F.col("months"), n), F.lit(0.0)).alias("avg_tenure"),
        F.coalesce(ratio(n, F.sum(n).over(per_field)), F.lit(0.0)).alias("share_of_base"))


def churn_decomposition(c360: DataFrame) -> DataFrame:
    """Drill-down contract, internet, payment, tenure band: rollup, one row per node."""
    keys = ["contract_type", "internet_service", "payment_method", "tenure_band"]
    rolled = c360.rollup(*keys).agg(
        F.grouping_id().alias("gid"), F.count("*").alias("customers"), F.sum("churn").alias("churned"))
    depth = F.lit(4) - F.bit_count("gid")
    return rolled.select(depth.cast("int").alias("depth"), *keys, "customers", "churned",
                         ratio(F.col("churned"), F.col("customers")).alias("churn_rate"))


def tier_by_status(scores: DataFrame, c360: DataFrame) -> DataFrame:
    joined = scores.select("customer_id", "risk_tier").join(c360.select("customer_id", "churn"), "customer_id")
    return joined.groupBy("risk_tier", X.status(F.col("churn")).alias("status")).agg(
        F.count("*").alias("customers"))


def segment_scatter(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("segment_name").agg(
        mean_of(F.col("tenure")).alias("avg_tenure"), mean_of(F.col("monthly_charges")).alias("arpu"),
        F.count("*").alias("customers"))


def segment_table(segmented: DataFrame) -> DataFrame:
    return segmented.where(F.col("segment_name").isNotNull()).groupBy("segment_name").agg(
        F.count("*").alias("customers"), mean_of(F.col("churn")).alias("churn_rate"),
        mean_of(F.col("monthly_charges")).alias("avg_monthly_charge"),
        mean_of(F.col("tenure")).alias("avg_tenure"), mean_of(F.col("n_services")).alias("avg_services"),
        _lost().cast("double").alias("mrr_lost"))


def risk_tier_table(report: DataFrame) -> DataFrame:
    """Per tier, all four tiers shown: size, predicted and actual rate, revenue, expected loss."""
    p = F.col("churn_probability").cast("decimal(9,5)")
    found = report.groupBy("risk_tier").agg(
        F.count("*").alias("customers"), mean_of(p).alias("avg_predicted"),
        mean_of(F.col("churn")).alias("actual_rate"),
        F.sum("monthly_charges").cast("double").alias("mrr"),
        F.sum(p * F.col("monthly_charges")).cast("double").alias("expected_mrr_at_risk"))
    tiers = report.sparkSession.createDataFrame(
        [(t, i) for i, (t, _) in enumerate(D.RISK_TIERS, 1)], "risk_tier string, tier_order int")
    return tiers.join(found, "risk_tier", "left").select(
        "risk_tier", "tier_order", F.coalesce("customers", F.lit(0)).alias("customers"),
        *[F.coalesce(c, F.lit(0.0)).alias(c)
          for c in ("avg_predicted", "actual_rate", "mrr", "expected_mrr_at_risk")])
