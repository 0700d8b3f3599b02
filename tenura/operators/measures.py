"""Catalogue of named business measures, evaluated for any grouping and filter."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.functions import domain as D
from tenura.functions.numeric import half_up, ratio
from tenura.operators.ordering import running_totals
from tenura.operators.evaluate import threshold_sums


def _where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def _catalog() -> dict[str, Column]:
    left, stayed = F.col("churn") == 1, F.col("churn") == 0
    rows, gone = F.count("*"), F.count_if(left)
    charge = F.col("monthly_charges")
    mrr, lost = F.sum(charge), F.coalesce(_where(left, charge), F.lit(0))
    p = F.col("churn_probability").cast("decimal(9,5)")
    scored = F.col("churn_probability").isNotNull()
    risky = F.col("risk_tier").isin("High", "Critical")
    test, targeted = F.col("split") == "test", F.col("targeted") == 1
    return {
        "customers": rows,
        "churned_customers": gone,
        "active_customers": rows - gone,
        "churn_rate": ratio(gone, rows),
        "retention_rate": 1.0 - ratio(gone, rows),
        "mrr": mrr.cast("double"),
        "mrr_lost": lost.cast("double"),
        "mrr_lost_pct": ratio(lost, mrr),
        "annualised_revenue_lost": (lost * 12).cast("double"),
        "arpu": ratio(mrr, rows),
        "arpu_churned": ratio(_where(left, charge), gone),
        "arpu_retained": ratio(_where(stayed, charge), F.count_if(stayed)),
        "lifetime_revenue": F.sum("total_charges").cast("double"),
        "avg_tenure": ratio(F.sum("tenure"), F.count("tenure")),
        "avg_churn_probability": ratio(F.sum(p), F.count(p)),
        "expected_churners": F.sum(p).cast("double"),
        "expected_mrr_at_risk": F.sum(p * charge).cast("double"),
        "high_risk_customers": F.count_if(scored & risky),
        "high_risk_active_customers": F.count_if(scored & risky & stayed),
        "targeted_customers": F.count_if(targeted),
        "campaign_precision_test": ratio(F.count_if(test & targeted & left), F.count_if(test & targeted)),
        "campaign_recall_test": ratio(F.count_if(test & targeted & left), F.count_if(test & scored & left)),
    }


BASE = ["customers", "churned_customers", "active_customers", "churn_rate", "retention_rate", "mrr", "mrr_lost",
        "mrr_lost_pct", "annualised_revenue_lost", "arpu", "arpu_churned", "arpu_retained", "lifetime_revenue",
        "avg_tenure"]
SCORES = ["avg_churn_probability", "expected_churners", "expected_mrr_at_risk", "high_risk_customers",
          "high_risk_active_customers", "targeted_customers", "campaign_precision_test", "campaign_recall_test"]


def measure(frame: DataFrame, names: list[str], group_by: list[str] = (), where: Column | None = None) -> DataFrame:
    """Named measures per group: one scan, one aggregation."""
    catalog = _catalog()
    rows = frame if where is None else frame.where(where)
    return rows.groupBy(*group_by).agg(*[catalog[n].alias(n) for n in names])


def with_scores(c360: DataFrame, scores: DataFrame) -> DataFrame:
    """Customers with their score row (1:1)."""
    return c360.join(scores.select("customer_id", "churn_probability", "risk_tier", "split", "targeted"), "customer_id")


def compare_measures(frame: DataFrame, group_by: list[str]) -> DataFrame:
    """Rate against the whole base in points, dense rank of the rate, share of all lost revenue.

    The base total ignores the grouping but keeps filters already applied to the rows.
    """
    per = measure(frame, ["customers", "churn_rate", "mrr_lost"], group_by)
    overall = measure(frame, ["churn_rate"]).scalar()
    every = Window.partitionBy(F.lit(0))                   # windows over groups, not customers
    lost = F.col("mrr_lost").cast(D.MONEY)
    return per.select(
        *group_by, "customers", "churn_rate",
        ((F.col("churn_rate") - overall) * 100).alias("churn_rate_vs_overall"),
        F.dense_rank().over(every.orderBy(F.desc("churn_rate"))).alias("churn_rate_rank"),
        ratio(lost, F.sum(lost).over(every)).alias("share_of_mrr_lost"))


def cumulative_mrr_lost(frame: DataFrame, bands: DataFrame) -> DataFrame:
    """Running share of lost revenue over the tenure bands."""
    per = measure(frame, ["mrr_lost"], ["tenure_band"]).join(bands, "tenure_band") \
        .withColumn("lost", F.col("mrr_lost").cast(D.MONEY))
    run = running_totals(per, [], "band_order", {"upto": "lost"}, bounded=True)
    total = F.sum("lost").over(Window.partitionBy(F.lit(0)))
    return run.select("tenure_band", "band_order", "mrr_lost", ratio(F.col("upto"), total).alias("cumulative_mrr_lost_pct"))


def rate_with_service(c360: DataFrame, bridge: DataFrame, service: str | None = None, status: str = "Yes") -> DataFrame:
    """Churn rate of customers with at least one bridge row of the status (of one service, or any)."""
    hits = bridge.where(F.col("status") == status)
    if service is not None:
        hits = hits.where(F.col("service_name") == service)
    having = c360.join(hits.select("customer_id"), "customer_id", "left_semi")
    return measure(having, ["customers", "churn_rate"])


def rate_without_service(c360: DataFrame, bridge: DataFrame, service: str | None = None) -> DataFrame:
    return rate_with_service(c360, bridge, service, "No")


def addon_measures(wide: DataFrame) -> DataFrame:
    """Adoption and churn with/without per service, and for any service (service_name 'any').

    "Any" counts a customer once however many rows match, so it is a condition over the six columns.
    """
    tall = wide.select("churn", *D.ADDONS).unpivot("churn", D.ADDONS, "service_name", "status")
    yes, no = F.col("status") == "Yes", F.col("status") == "No"

    def rate(cond):
        return ratio(F.sum(F.when(cond, F.col("churn"))), F.count_if(cond))

    adoption = ratio(F.count_if(yes), F.count_if(F.col("status") != "No internet service"))
    per = tall.groupBy("service_name").agg(
        adoption.alias("adoption"), rate(yes).alias("rate_with"), rate(no).alias("rate_without"))
    has_yes, has_no = F.lit(False), F.lit(False)
    for a in D.ADDONS:
        has_yes, has_no = has_yes | (F.col(a) == "Yes"), has_no | (F.col(a) == "No")
    total = tall.agg(adoption).scalar()
    everyone = wide.agg(rate(has_yes).alias("rate_with"), rate(has_no).alias("rate_without")).select(
        F.lit("any").alias("service_name"), total.alias("adoption"), "rate_with", "rate_without")
    return per.unionByName(everyone)


# Slider values of the what-if page.
OFFER_COSTS = [float(c) for c in range(10, 151, 5)]
ACCEPTANCE = [k / 20 for k in range(1, 13)]
MONTHS = list(range(1, 25))
THRESHOLDS = [k / 100 for k in range(5, 96)]


def campaign_what_if(scored: DataFrame, thresholds=THRESHOLDS, costs=OFFER_COSTS, acceptance=ACCEPTANCE,
                     months=MONTHS) -> DataFrame:
    """Campaign measures for every combination of slider values.

    Customers are summed up per threshold first; the other parameters are generated from those few
    rows, so their number does not touch the customers.
    """
    grid = threshold_sums(scored, list(thresholds), [])
    for name, values in (("offer_cost", costs), ("acceptance", acceptance), ("months", months)):
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    cost = F.col("contacted") * F.col("offer_cost")
    saved = F.col("charges") * F.col("acceptance") * F.col("months")
    return grid.select(
        "threshold", "offer_cost", "acceptance", F.col("months").cast("int").alias("months"),
        "contacted", cost.alias("cost"), saved.alias("revenue_saved"), (saved - cost).alias("net_value"),
        F.try_divide(saved - cost, cost).alias("roi"))


def measure_labels(frame: DataFrame, group_by: list[str]) -> DataFrame:
    """Alert colour of the churn rate and a subtitle line."""
    per = measure(frame, ["customers", "churn_rate", "mrr_lost"], group_by)
    colour = None
    for limit, code in D.ALERT_BANDS:
        if limit is None:
            colour = colour.otherwise(code)
        else:
            step = F.col("churn_rate") >= limit
            colour = F.when(step, code) if colour is None else colour.when(step, code)
    subtitle = F.concat(
        F.format_number("customers", 0), F.lit(" customers · "),
        F.format_number(half_up(100.0 * F.col("churn_rate"), 1), 1), F.lit("% churn · $"),
        F.format_number(half_up("mrr_lost", 0), 0), F.lit(" MRR lost"))
    return per.select(*group_by, colour.alias("churn_rate_colour"), subtitle.alias("kpi_subtitle"))


def call_list(c360: DataFrame, scores: DataFrame, k: int = 100) -> DataFrame:
    """Active high-risk customers by probability x charge, best first (a top-k report)."""
    risky = scores.where(F.col("risk_tier").isin("High", "Critical")) \
        .select("customer_id", "churn_probability", "risk_tier")
    active = c360.where(F.col("churn") == 0).select("customer_id", "contract_type", "monthly_charges")
    worth = (F.col("churn_probability").cast("decimal(9,5)") * F.col("monthly_charges")).cast("double")
    return active.join(risky, "customer_id").withColumn("expected_loss", worth) \
        .orderBy(F.desc("expected_loss"), "customer_id").limit(k)
