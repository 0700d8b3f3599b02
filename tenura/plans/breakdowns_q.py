"""Queries: the business questions, exploratory tables and report tables."""

from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.operators import breakdowns as B
from tenura.operators import ordering, scoring, segments
from tenura.plans.catalog import query
from tenura.plans.check_sql import dbl, r, ratio, sql

LOST = "sum(monthly_charges) FILTER (churn = 1)"
LOST0 = f"coalesce({LOST}, 0)"


@query("churn_by_contract", sql(f"""
    SELECT contract_type, internet_service, count(*) AS customers, CAST(sum(churn) AS BIGINT) AS churned,
           {r(f"100.0e0 * {ratio('sum(churn)', 'count(*)')}", 2)} AS churn_rate_pct,
           {r(ratio('sum(monthly_charges)', 'count(*)'), 2)} AS avg_monthly_charge,
           {dbl('sum(monthly_charges)')} AS mrr, {dbl(LOST0)} AS mrr_lost
    FROM mart GROUP BY contract_type, internet_service""", "mart"))
def _(w):
    return B.churn_by_contract(w.customer_360())


@query("revenue_at_risk", sql(f"""
    SELECT a.segment, a.churned, {dbl('a.lost')} AS mrr_lost,
           {r(f"100.0e0 * {ratio('a.lost', 't.total')}", 2)} AS pct_of_total_loss,
           {r(f"100.0e0 * {ratio('sum(b.lost)', 't.total')}", 2)} AS cumulative_pct,
           CAST(count(*) FILTER (b.lost > a.lost) + 1 AS INTEGER) AS loss_rank
    FROM per a CROSS JOIN (SELECT sum(lost) AS total FROM per) t
    JOIN per b ON b.lost > a.lost OR (b.lost = a.lost AND b.segment <= a.segment)
    GROUP BY a.segment, a.churned, a.lost, t.total""", "mart", extra={"per": f"""
        SELECT contract || ' / ' || payment_method AS segment, CAST(sum(churn) AS BIGINT) AS churned,
               {LOST0} AS lost FROM mart GROUP BY contract, payment_method"""}))
def _(w):
    return B.revenue_at_risk(w.customer_360())


@query("tenure_cohorts", sql(f"""
    SELECT tenure_band, min(tenure) AS min_tenure, count(*) AS customers,
           {r(f"100.0e0 * {ratio('sum(churn)', 'count(*)')}", 2)} AS churn_rate_pct,
           {r(ratio('sum(monthly_charges)', 'count(*)'), 2)} AS avg_monthly_charge,
           {r(ratio('sum(n_services)', 'count(*)'), 2)} AS avg_services,
           {r(f"100.0e0 * {ratio('count(*) FILTER (contract_months = 1)', 'count(*)')}", 1)} AS pct_month_to_month
    FROM mart GROUP BY tenure_band""", "mart"))
def _(w):
    return B.tenure_cohorts(w.customer_360())


_yes = ratio("sum(churn) FILTER (status = 'Yes')", "count(*) FILTER (status = 'Yes')")
_no = ratio("sum(churn) FILTER (status = 'No')", "count(*) FILTER (status = 'No')")
_net = {"net": "SELECT b.service_name, b.status, m.churn FROM bridge b JOIN mart m USING (customer_id) "
               "WHERE m.internet_service <> 'No'"}


@query("addon_impact", sql(f"""
    SELECT service_name, {r(f'100.0e0 * {_yes}', 2)} AS churn_with_pct,
           {r(f'100.0e0 * {_no}', 2)} AS churn_without_pct,
           {r(f'100.0e0 * {_no} - 100.0e0 * {_yes}', 2)} AS churn_gap_pts,
           count(*) FILTER (status = 'Yes') AS adopters,
           {r(f"100.0e0 * {ratio('count(*) FILTER (status = $$Yes$$)', 'count(*)')}", 1)} AS adoption_pct
    FROM net GROUP BY service_name""", "bridge", "mart", extra=_net))
def _(w):
    return B.addon_impact(w.mart())


@query("addon_effect", sql(f"""
    SELECT replace(service_name, '_', ' ') AS service, {_yes} AS with_addon, {_no} AS without_addon
    FROM net GROUP BY service_name""", "bridge", "mart", extra=_net))
def _(w):
    return B.addon_effect(w.mart())


@query("payment_billing", sql(f"""
    SELECT * FROM (
        SELECT payment_method, CASE paperless_billing WHEN 1 THEN 'Paperless' ELSE 'Paper' END AS billing,
               count(*) AS customers, {r(f"100.0e0 * {ratio('sum(churn)', 'count(*)')}", 2)} AS churn_rate_pct,
               {r(ratio('sum(tenure)', 'count(*)'), 1)} AS avg_tenure
        FROM mart GROUP BY payment_method, paperless_billing) WHERE customers >= 50""", "mart"))
def _(w):
    return B.payment_billing(w.customer_360())


@query("high_value_at_risk", sql(f"""
    SELECT contract_type, internet_service, count(*) AS top_quartile_customers,
           CAST(sum(churn) AS BIGINT) AS churned,
           {r(f"100.0e0 * {ratio('sum(churn)', 'count(*)')}", 2)} AS churn_rate_pct,
           {r(f'{LOST0} * 12', 0)} AS annualised_revenue_lost
    FROM (SELECT *, ntile(4) OVER (ORDER BY monthly_charges NULLS FIRST, md5('tie:' || customer_id), customer_id) AS q FROM mart)
    WHERE q = 4 GROUP BY contract_type, internet_service""", "mart"))
def _(w):
    return B.high_value_at_risk(w.customer_360())


@query("model_risk_tiers", sql(f"""
    SELECT model_name, risk_tier, count(*) AS customers,
           {r(ratio('sum(CAST(p AS DECIMAL(9,5)))', 'count(*)'), 3)} AS avg_predicted,
           {r(ratio('sum(y)', 'count(*)'), 3)} AS actual_rate, {dbl('sum(monthly_charges)')} AS mrr_in_tier
    FROM scored GROUP BY model_name, risk_tier""", "scored"))
def _(w):
    return B.model_risk_tiers(w.model_scores(), w.customer_360())


# ---------------------------------------------------------------- exploratory
@query("category_rates", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level,
           {r(ratio('sum(churn)', 'count(*)'), 3)} AS rate, count(*) AS n FROM mart GROUP BY {c}"""
                                                for c in D.RATE_FEATURES), "mart"))
def _(w):
    return B.category_rates(w.mart(), D.RATE_FEATURES)


@query("target_balance", sql(f"""
    SELECT CASE churn WHEN 1 THEN 'churned' ELSE 'retained' END AS outcome,
           {ratio('count(*)', '(SELECT count(*) FROM feat)')} AS share FROM feat GROUP BY churn""", "feat"))
def _(w):
    return B.target_balance(w.customer_360())


SUMMARY = ["senior_citizen", "partner", "dependents", "family", "contract_months", "auto_pay", "tenure",
           "phone_service", "paperless_billing", "n_addons", "n_services", "monthly_charges",
           "total_charges", "charge_drift", "churn", "price_vs_peers", "tenure_pct_in_contract"]


@query("numeric_summary", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS feature, count(v) AS count, {r(f"{dbl('sum(v)')} / count(v)", 2)} AS mean,
           {r("stddev_samp(CAST(v AS DOUBLE))", 2)} AS std, {r('min(v)', 2)} AS min,
           {r('quantile_cont(CAST(v AS DOUBLE), 0.25)', 2)} AS p25,
           {r('quantile_cont(CAST(v AS DOUBLE), 0.5)', 2)} AS p50,
           {r('quantile_cont(CAST(v AS DOUBLE), 0.75)', 2)} AS p75, {r('max(v)', 2)} AS max
    FROM (SELECT CAST({r(c, 6)} AS DECIMAL(20,6)) AS v FROM mart)""" for c in SUMMARY), "mart"))
def _(w):
    return B.numeric_summary(w.mart(), SUMMARY)


@query("rate_pivot", sql(f"""
    SELECT contract_type, """ + ", ".join(
    f"{ratio(f'sum(churn) FILTER (internet_service = $${v}$$)', f'count(*) FILTER (internet_service = $${v}$$)')} "
    f"AS rate_{v.split()[0].lower()}, nullif(count(*) FILTER (internet_service = $${v}$$), 0) AS n_{v.split()[0].lower()}"
    for v in ["DSL", "Fiber optic", "No"]) + " FROM mart GROUP BY contract_type", "mart"))
def _(w):
    return B.rate_pivot(w.customer_360())


QUARTILES = ["cheapest", "q2", "q3", "priciest"]


@query("rate_crosstab_by_quartile", sql(
    "SELECT contract_type, internet_service, " + ", ".join(
        r(ratio(f"sum(churn) FILTER (q = '{q}')", f"count(*) FILTER (q = '{q}')"), 3) + f" AS {q}"
        for q in QUARTILES) + " FROM tagged GROUP BY contract_type, internet_service", "mart",
    extra={"tagged": """
        SELECT *, CASE WHEN price_vs_peers <= e[1] THEN 'cheapest' WHEN price_vs_peers <= e[2] THEN 'q2'
                       WHEN price_vs_peers <= e[3] THEN 'q3' ELSE 'priciest' END AS q
        FROM mart, (SELECT quantile_cont(price_vs_peers, [0.25, 0.5, 0.75]) AS e FROM mart)"""}))
def _(w):
    tagged = ordering.quantile_cut(w.mart(), "price_vs_peers", QUARTILES, "price_quartile")
    return B.rate_crosstab_by_quartile(tagged, QUARTILES)


@query("density_histogram", sql(f"""
    SELECT churn, bin, {r('lo + bin * w', 6)} AS bin_start, count(*) AS n,
           {r(f"count(*) / (total * w)", 6)} AS density
    FROM (SELECT churn, lo, w, total, CAST(least(floor((tenure - lo) / w), 35) AS INTEGER) AS bin
          FROM feat JOIN (SELECT churn, CAST(min(tenure) AS DOUBLE) AS lo,
                                 (CAST(max(tenure) AS DOUBLE) - min(tenure)) / 36 AS w, count(*) AS total
                          FROM feat GROUP BY churn) USING (churn))
    GROUP BY churn, bin, lo, w, total""", "feat"))
def _(w):
    return B.density_histogram(w.customer_360(), "tenure")


@query("charge_histogram", sql("""
    SELECT floor(CAST(monthly_charges AS DOUBLE) / 5) * 5 AS charge_from,
           CASE churn WHEN 1 THEN 'Churned' ELSE 'Active' END AS status, count(*) AS customers
    FROM feat GROUP BY 1, 2""", "feat"))
def _(w):
    return B.charge_histogram(w.customer_360())


@query("box_stats", sql(f"""
    SELECT internet_service, status, max(n) AS n, {r('max(q[1])', 6)} AS q1, {r('max(q[2])', 6)} AS median,
           {r('max(q[3])', 6)} AS q3, min(v) FILTER (ok) AS whisker_low, max(v) FILTER (ok) AS whisker_high,
           count(*) FILTER (NOT ok) AS outliers
    FROM (SELECT s.*, n, q, v BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1]) AS ok
          FROM s JOIN (SELECT internet_service, status, count(*) AS n, quantile_cont(v, [0.25, 0.5, 0.75]) AS q
                       FROM s GROUP BY ALL) USING (internet_service, status))
    GROUP BY internet_service, status""", "mart", extra={"s": """
        SELECT internet_service, CASE churn WHEN 1 THEN 'Churned' ELSE 'Retained' END AS status,
               CAST(monthly_charges AS DOUBLE) AS v FROM mart"""}))
def _(w):
    tagged = w.customer_360().withColumn("status", F.when(F.col("churn") == 1, "Churned").otherwise("Retained"))
    return B.box_stats(tagged, ["internet_service", "status"], "monthly_charges")


# ---------------------------------------------------------------- reports
@query("kpi_summary", sql(f"""
    SELECT count(*) AS customers, CAST(sum(churn) AS BIGINT) AS churned, {ratio('sum(churn)', 'count(*)')} AS churn_rate,
           {dbl('sum(monthly_charges)')} AS mrr, {dbl(LOST0)} AS mrr_lost,
           coalesce({ratio(LOST0, 'sum(monthly_charges)')}, 0) AS mrr_lost_share,
           {ratio('sum(tenure) FILTER (churn = 1)', 'count(*) FILTER (churn = 1)')} AS avg_tenure_churned,
           {ratio('sum(tenure) FILTER (churn = 0)', 'count(*) FILTER (churn = 0)')} AS avg_tenure_retained
    FROM feat""", "feat"))
def _(w):
    return B.kpi_summary(w.customer_360())


_levels = ", ".join(f"('{f}', '{v}', {i})" for f, vs in B.BREAKDOWN_LEVELS.items() for i, v in enumerate(vs, 1))


@query("dimension_breakdown", sql(f"""
    SELECT l.field, l.level, l.level_order, count(t.churn) AS customers,
           CAST(coalesce(sum(t.churn), 0) AS BIGINT) AS churned,
           coalesce({ratio('sum(t.churn)', 'count(t.churn)')}, 0) AS churn_rate,
           coalesce({dbl('sum(t.monthly_charges)')}, 0) AS mrr,
           coalesce({dbl('sum(t.monthly_charges) FILTER (t.churn = 1)')}, 0) AS mrr_lost,
           coalesce({ratio('sum(t.tenure)', 'count(t.churn)')}, 0) AS avg_tenure,
           coalesce({ratio('count(t.churn)', 'sum(count(t.churn)) OVER (PARTITION BY l.field)')}, 0) AS share_of_base
    FROM (VALUES {_levels}) AS l(field, level, level_order)
    LEFT JOIN tall t ON t.field = l.field AND t.level = l.level
    GROUP BY l.field, l.level, l.level_order""", "mart", extra={"tall": " UNION ALL ".join(
        f"SELECT '{f}' AS field, {f} AS level, churn, monthly_charges, tenure FROM mart" for f in B.BREAKDOWN_LEVELS)}))
def _(w):
    return B.dimension_breakdown(w.customer_360())


_decomp = ["contract_type", "internet_service", "payment_method", "tenure_band"]


@query("churn_decomposition", sql(" UNION ALL ".join(
    f"SELECT {d} AS depth, " + ", ".join(
        c if i < d else f"CAST(NULL AS VARCHAR) AS {c}" for i, c in enumerate(_decomp))
    + f", count(*) AS customers, CAST(sum(churn) AS BIGINT) AS churned, {ratio('sum(churn)', 'count(*)')} AS churn_rate "
    + "FROM mart" + (f" GROUP BY {', '.join(_decomp[:d])}" if d else "") for d in range(5)), "mart"))
def _(w):
    return B.churn_decomposition(w.customer_360())


@query("tier_by_status", sql("""
    SELECT risk_tier, CASE y WHEN 1 THEN 'Churned' ELSE 'Active' END AS status, count(*) AS customers
    FROM best GROUP BY 1, 2""", "best"))
def _(w):
    return B.tier_by_status(w.best_scores(), w.customer_360())


@query("attach_scores_segments", sql(f"""
    SELECT m.customer_id, gender, senior_citizen, partner, dependents, contract_type, payment_method,
           internet_service, m.tenure, tenure_band, n_services, {dbl('m.monthly_charges')} AS monthly_charges,
           {dbl('m.total_charges')} AS total_charges, churn, b.p AS churn_probability, b.risk_tier,
           'n/a' AS segment_name, b.split
    FROM mart m LEFT JOIN (SELECT * FROM best WHERE split <> 'valid') b USING (customer_id)""", "best", "mart"))
def _(w):
    """Customers without a score keep their row; no segmentation gives the default label."""
    scores = w.best_scores().where(F.col("split") != "valid")
    out = scoring.attach_scores_segments(w.customer_360(), scores, None)
    return out.withColumns({c: F.col(c).cast("double") for c in ("monthly_charges", "total_charges")})


def _report(w):
    return scoring.attach_scores_segments(w.customer_360(), w.best_scores(), None)


@query("risk_tier_table", sql(f"""
    SELECT l.risk_tier, l.tier_order, count(b.y) AS customers,
           coalesce({ratio('sum(CAST(b.p AS DECIMAL(9,5)))', 'count(b.y)')}, 0) AS avg_predicted,
           coalesce({ratio('sum(b.y)', 'count(b.y)')}, 0) AS actual_rate,
           coalesce({dbl('sum(b.monthly_charges)')}, 0) AS mrr,
           coalesce({dbl('sum(CAST(b.p AS DECIMAL(9,5)) * CAST(b.monthly_charges AS DECIMAL(18,2)))')}, 0)
               AS expected_mrr_at_risk
    FROM (VALUES ('Low', 1), ('Medium', 2), ('High', 3), ('Critical', 4)) AS l(risk_tier, tier_order)
    LEFT JOIN best b USING (risk_tier) GROUP BY l.risk_tier, l.tier_order""", "best"))
def _(w):
    return B.risk_tier_table(_report(w))


_seg_name = {"named": """
    SELECT *, 'segment ' || segment_id AS segment_name FROM seg"""}


def _segmented(w):
    return w.segments().withColumn("segment_name", F.concat(F.lit("segment "), F.col("segment_id")))


@query("segment_scatter", sql(f"""
    SELECT segment_name, {ratio('sum(tenure)', 'count(*)')} AS avg_tenure,
           {ratio('sum(monthly_charges)', 'count(*)')} AS arpu, count(*) AS customers
    FROM named GROUP BY segment_name""", "seg", extra=_seg_name))
def _(w):
    return B.segment_scatter(_segmented(w))


@query("segment_table", sql(f"""
    SELECT segment_name, count(*) AS customers, {ratio('sum(churn)', 'count(*)')} AS churn_rate,
           {ratio('sum(monthly_charges)', 'count(*)')} AS avg_monthly_charge,
           {ratio('sum(tenure)', 'count(*)')} AS avg_tenure, {ratio('sum(n_services)', 'count(*)')} AS avg_services,
           {dbl(LOST0)} AS mrr_lost
    FROM named GROUP BY segment_name""", "seg", extra=_seg_name))
def _(w):
    return B.segment_table(_segmented(w))
