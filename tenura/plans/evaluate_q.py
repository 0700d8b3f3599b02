"""Queries: split, survival, association statistics, metrics, campaign and measures."""

from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.functions.numeric import half_up
from tenura.operators import evaluate as E
from tenura.operators import measures as M
from tenura.operators import ordering, scoring, segments, split, stats, survival
from tenura.plans.catalog import all_oracles, query
from tenura.plans.check_sql import dbl, r, ratio, sql


def rounded(df, digits, *columns):
    return df.withColumns({c: half_up(c, digits) for c in columns})


# ---------------------------------------------------------------- split
@query("stratified_split", sql("SELECT customer_id, churn, split FROM splits JOIN mart USING (customer_id)",
                               "splits", "mart"))
def _(w):
    return split.stratified_split(w.mart().select("customer_id", "churn"))


@query("split_quotas", sql("SELECT churn, n, test_rows, valid_rows FROM quota", "quota"))
def _(w):
    return split.split_quotas(w.mart(), "churn", D.SplitSizes())


@query("split_assignment", sql("SELECT customer_id, split FROM splits", "splits"))
def _(w):
    one = w.scored().where(F.col("model_name") == "scorecard")
    return split.split_assignment(one)


@query("stratified_folds", sql("""
    SELECT customer_id, churn, CAST(ntile(5) OVER (PARTITION BY churn ORDER BY md5('fold42:' || customer_id),
                                                   customer_id) - 1 AS INTEGER) AS fold FROM mart""", "mart"))
def _(w):
    return split.stratified_folds(w.mart().select("customer_id", "churn")).select("customer_id", "churn", "fold")


# ---------------------------------------------------------------- survival
def _km(table, group, t, e):
    """Curve by self-joins on the distinct times: at risk counted directly, survival as a product."""
    g = ", ".join(group) + ", " if group else ""
    on = " AND ".join([f"a.{c} = b.{c}" for c in group] + ["b.t >= a.t"])
    part = f"PARTITION BY {', '.join(group)}" if group else ""
    return {
        "src": f"SELECT {g}CAST({t} AS DOUBLE) AS t, {e} AS e FROM {table}",
        "event_times": f"SELECT DISTINCT {g}t FROM src WHERE e = 1",
        "risk": f"SELECT {', '.join('a.' + c for c in group) + ', ' if group else ''}a.t, count(*) AS n, "
                f"count(*) FILTER (b.t = a.t AND b.e = 1) AS d FROM event_times a JOIN src b ON {on} GROUP BY ALL",
        "steps": f"SELECT *, product(1 - CAST(d AS DOUBLE) / n) OVER w AS s, "
                 f"sum(CASE WHEN n > d THEN CAST(d AS DOUBLE) / (CAST(n AS DOUBLE) * (n - d)) ELSE 0 END) OVER w AS g "
                 f"FROM risk WINDOW w AS ({part} ORDER BY t)",
        "curve": f"""
            SELECT {g}t, n AS at_risk, d AS events, {r('s', 9)} AS survival,
                   {r('CASE WHEN s = 0 THEN 0 ELSE pow(s, exp(1.96e0 * sqrt(g) / abs(ln(s)))) END', 9)} AS ci_low,
                   {r('CASE WHEN s = 0 THEN 0 ELSE pow(s, exp(-1.96e0 * sqrt(g) / abs(ln(s)))) END', 9)} AS ci_high
            FROM steps
            UNION ALL
            SELECT {g}0.0e0, count(*), 0, 1.0e0, 1.0e0, 1.0e0 FROM src {'GROUP BY ' + ', '.join(group) if group else ''}
            HAVING coalesce(min(t) FILTER (e = 1), 1) <> 0""",
    }


CURVE = ["survival", "ci_low", "ci_high"]


@query("kaplan_meier", sql("SELECT * FROM curve", "mart", extra=_km("mart", [], "tenure", "churn")))
def _(w):
    return rounded(survival.kaplan_meier(w.customer_360()), 9, *CURVE)


@query("km_by_group", sql("SELECT * FROM curve", "mart", extra=_km("mart", ["contract_type"], "tenure", "churn")))
def _(w):
    return rounded(survival.km_by_group(w.customer_360(), ["contract_type"]), 9, *CURVE)


@query("kaplan_meier_activity", sql("SELECT * FROM curve", "spans", extra=_km("spans", [], "duration", "stopped")))
def _(w):
    return rounded(survival.kaplan_meier(w.activity(), "duration", "stopped"), 9, *CURVE)


@query("median_survival", sql("SELECT contract_type, min(t) FILTER (survival <= 0.5) AS median FROM curve GROUP BY 1",
                              "mart", extra=_km("mart", ["contract_type"], "tenure", "churn")))
def _(w):
    return survival.median_survival(survival.km_by_group(w.customer_360(), ["contract_type"]), ["contract_type"])


@query("retention_summary", sql("""
    SELECT contract_type, max(at_risk) AS customers, arg_max(survival, t) FILTER (t <= 12) AS s_12,
           arg_max(survival, t) FILTER (t <= 24) AS s_24, min(t) FILTER (survival <= 0.5) AS median_months
    FROM curve GROUP BY contract_type""", "mart", extra=_km("mart", ["contract_type"], "tenure", "churn")))
def _(w):
    return rounded(survival.retention_summary(w.customer_360(), "contract_type"), 9, "s_12", "s_24")


@query("logrank_test", sql(f"""
    SELECT {r('sum(d1 - d * n1 / n) ^ 2 / sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END)', 6)} AS chi2
    FROM (SELECT a.t, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (g) AS DOUBLE) AS n1,
                 CAST(count(*) FILTER (b.t = a.t AND e = 1) AS DOUBLE) AS d,
                 CAST(count(*) FILTER (b.t = a.t AND e = 1 AND g) AS DOUBLE) AS d1
          FROM (SELECT DISTINCT tenure AS t FROM mart WHERE churn = 1) a
          JOIN (SELECT tenure AS t, churn AS e, contract_type = 'Month-to-month' AS g FROM mart) b ON b.t >= a.t
          GROUP BY a.t)""", "mart"))
def _(w):
    rows = w.customer_360().withColumn("monthly", (F.col("contract_type") == "Month-to-month").cast("int"))
    return rounded(survival.logrank_test(rows, "monthly", with_p=False), 6, "chi2")


def _simpson(density: str, start: str, width: float, steps: int = 4000) -> str:
    """Integral of `density` (of t) from `start` over `width` in SQL."""
    h = width / steps
    t = f"({start} + i * {h!r})"
    return (f"({h!r} / 3 * list_sum(list_transform(range(0, {steps + 1}), lambda i: "
            f"(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * ({density.replace('$t', t)}))))")


def _normal_p(z: str) -> str:
    """Two-sided tail of the standard normal distribution."""
    return f"least(1.0, 2 / sqrt(2 * pi()) * {_simpson('exp(-$t * $t / 2)', z, 12.0)})"


def _chi2_p(chi2: str, dof: str) -> str:
    """Upper tail; one degree of freedom by the normal distribution, whose density has no pole."""
    inside = _simpson(f"exp(({dof} / 2.0 - 1) * ln(greatest($t, 1e-300)) - $t / 2 - {dof} / 2.0 * ln(2.0) - lgamma({dof} / 2.0))",
                      chi2, 120.0)
    return f"CASE WHEN {dof} = 1 THEN {_normal_p(f'sqrt({chi2})')} ELSE least(1.0, {inside}) END"


_logrank = all_oracles()["logrank_test"]


@query("logrank_p_value", f"SELECT chi2, {r(_chi2_p('chi2', '1'), 4)} AS p_value FROM ({_logrank})")
def _(w):
    rows = w.customer_360().withColumn("monthly", (F.col("contract_type") == "Month-to-month").cast("int"))
    return rounded(rounded(survival.logrank_test(rows, "monthly"), 6, "chi2"), 4, "p_value")


# ---------------------------------------------------------------- association
def _cramer(table, features, target):
    tall = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, CAST({target} AS VARCHAR) AS y FROM {table}"
        for c in features)
    return {
        "tall": tall,
        "grid": """SELECT feature, level, y, count(t.y2) AS o FROM
            (SELECT * FROM (SELECT DISTINCT feature, level FROM tall)
             JOIN (SELECT DISTINCT feature, y FROM tall) USING (feature)) g
            LEFT JOIN (SELECT feature, level, y, y AS y2 FROM tall) t USING (feature, level, y) GROUP BY ALL""",
        "margins": """SELECT *, sum(o) OVER (PARTITION BY feature) AS n,
                CAST(sum(o) OVER (PARTITION BY feature, level) AS DOUBLE) * sum(o) OVER (PARTITION BY feature, y)
                / sum(o) OVER (PARTITION BY feature) AS ex FROM grid""",
        "dims": """SELECT feature, count(DISTINCT level) AS nr, count(DISTINCT y) AS nc FROM tall GROUP BY feature""",
        "chi": """SELECT feature, CAST(max(n) AS BIGINT) AS n, max(nr) AS nr, max(nc) AS nc,
                sum(CASE WHEN nr = 2 AND nc = 2 THEN greatest(abs(o - ex) - 0.5, 0) ^ 2 ELSE (o - ex) ^ 2 END / ex) AS chi2
            FROM margins JOIN dims USING (feature) GROUP BY feature""",
    }


_cramer_out = f"""SELECT feature, n, {r('chi2', 6)} AS chi2, CAST((nr - 1) * (nc - 1) AS INTEGER) AS dof,
    {r('sqrt(chi2 / (n * (least(nr, nc) - 1)))', 6)} AS cramers_v FROM chi"""


@query("cramers_v", sql(_cramer_out, "mart", extra=_cramer("mart", D.ASSOCIATION_FEATURES, "churn")))
def _(w):
    return rounded(stats.cramers_v(w.mart(), D.ASSOCIATION_FEATURES, with_p=False), 6, "chi2", "cramers_v")


@query("cramers_v_labels", sql(_cramer_out, extra=_cramer("labels", ["quality"], "toxic")))
def _(w):
    return rounded(stats.cramers_v(w.source("labels"), ["quality"], "toxic", with_p=False), 6, "chi2", "cramers_v")


@query("cramers_v_p_value", f"SELECT feature, n, dof, {r(_chi2_p('chi2', 'dof'), 4)} AS p_value FROM ({all_oracles()['cramers_v']})")
def _(w):
    out = stats.cramers_v(w.mart(), D.ASSOCIATION_FEATURES)
    return rounded(out.select("feature", "n", "dof", "p_value"), 4, "p_value")


_mw = " UNION ALL ".join(f"""
    SELECT '{c}' AS feature, {r('max(m1)', 6)} AS median_churned, {r('max(m0)', 6)} AS median_retained,
           {r('max(u)', 6)} AS u, {r('1 - 2 * max(u) / max(ab)', 9)} AS rank_biserial,
           {r('(greatest(max(u), max(ab) - max(u)) - max(ab) / 2 - 0.5) / sqrt(max(ab) / 12.0 * (max(n) + 1 - max(ties) / (max(n) * (max(n) - 1.0e0))))', 6)} AS z
    FROM (SELECT sum(rk) FILTER (churn = 1) - count(*) FILTER (churn = 1) * (count(*) FILTER (churn = 1) + 1) / 2 AS u,
                 CAST(count(*) FILTER (churn = 1) AS DOUBLE) * count(*) FILTER (churn = 0) AS ab,
                 CAST(count(*) AS DOUBLE) AS n, median(v) FILTER (churn = 1) AS m1, median(v) FILTER (churn = 0) AS m0,
                 (SELECT sum(CAST(k AS DOUBLE) ^ 3 - k) FROM (SELECT count(*) AS k FROM mart GROUP BY {c})) AS ties
          FROM (SELECT churn, CAST({c} AS DOUBLE) AS v,
                       rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0e0 AS rk FROM mart))"""
                         for c in D.RANK_FEATURES)


@query("mann_whitney", sql(_mw, "mart"))
def _(w):
    out = stats.mann_whitney(w.mart(), D.RANK_FEATURES, with_p=False)
    out = rounded(out, 6, "median_churned", "median_retained", "u", "z")
    return rounded(out, 9, "rank_biserial")


@query("mann_whitney_p_value", f"SELECT feature, u, {r(_normal_p('greatest(z, 0)'), 4)} AS p_value FROM ({all_oracles()['mann_whitney']})")
def _(w):
    out = stats.mann_whitney(w.mart(), D.RANK_FEATURES).select("feature", "u", "p_value")
    return rounded(rounded(out, 6, "u"), 4, "p_value")


_ranks = {"ranked": "SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0e0 AS {c}"
    for c in D.CORRELATION_FEATURES) + " FROM mart"}


@query("spearman_matrix", sql(" UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, {r(f'corr({x}, {y})', 6)} AS rho FROM ranked"
    for x in D.CORRELATION_FEATURES for y in D.CORRELATION_FEATURES), "mart", extra=_ranks))
def _(w):
    return rounded(stats.spearman_matrix(w.mart(), D.CORRELATION_FEATURES), 6, "rho")


# ---------------------------------------------------------------- metrics on scorecards
def evaluation(w):
    return w.scored().select("customer_id", "model_name", F.col("churn").alias("y"),
                             F.col("churn_probability").alias("p"), "monthly_charges", "split")


AUC = """(SELECT model_name, {name} FROM (
    SELECT a.model_name, CAST(sum(CASE WHEN a.p > b.p THEN 2 WHEN a.p = b.p THEN 1 ELSE 0 END * a.k * b.k) AS DOUBLE)
               / (2 * CAST(sum(a.k * b.k) AS DOUBLE)) AS {name}
    FROM (SELECT model_name, p, count(*) AS k FROM {t} WHERE y = 1 GROUP BY ALL) a
    JOIN (SELECT model_name, p, count(*) AS k FROM {t} WHERE y = 0 GROUP BY ALL) b USING (model_name)
    GROUP BY a.model_name))"""
TEST = {"test": "SELECT * FROM scored WHERE split = 'test'", "valid": "SELECT * FROM scored WHERE split = 'valid'"}
CUM = {"levels": "SELECT model_name, p, count(*) AS k, sum(y) AS pos FROM {t} GROUP BY ALL",
       "cum": """SELECT model_name, p, k, pos, sum(k) OVER w AS cum_n, sum(pos) OVER w AS tp,
                 sum(k) OVER m AS total, sum(pos) OVER m AS positives FROM levels
                 WINDOW w AS (PARTITION BY model_name ORDER BY p DESC), m AS (PARTITION BY model_name)"""}


def cum(t):
    return {k: v.format(t=t) for k, v in CUM.items()}


AP = f"""(SELECT model_name, {r('sum((CAST(pos AS DOUBLE) / positives) * (CAST(tp AS DOUBLE) / cum_n))', 9)} AS pr_auc
          FROM cum GROUP BY model_name)"""
BRIER = "(SELECT model_name, CAST(sum((CAST(p AS DECIMAL(9,5)) - y) * (CAST(p AS DECIMAL(9,5)) - y)) AS DOUBLE) / count(*) AS brier FROM {t} GROUP BY model_name)"


def at_threshold(t, cut):
    called, tp = f"count(*) FILTER (p >= {cut})", f"count(*) FILTER (p >= {cut} AND y = 1)"
    return (f"(SELECT model_name, CAST({cut} AS DOUBLE) AS threshold, coalesce({ratio(tp, called)}, 0) AS precision, "
            f"coalesce({ratio(tp, 'sum(y)')}, 0) AS recall, coalesce({ratio(f'2 * {tp}', f'{called} + sum(y)')}, 0) AS f1 "
            f"FROM {t} GROUP BY model_name)")


LIFT = """(SELECT model_name, (CAST(sum(y) FILTER (rn <= greatest(floor(n * 0.1 + 1e-9), 1)) AS DOUBLE)
              / count(*) FILTER (rn <= greatest(floor(n * 0.1 + 1e-9), 1))) / (CAST(sum(y) AS DOUBLE) / count(*)) AS top_decile_lift
    FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY p DESC, md5('lift:' || customer_id), customer_id) AS rn,
                 count(*) OVER (PARTITION BY model_name) AS n FROM {t}) GROUP BY model_name)"""


@query("roc_auc", sql("SELECT * FROM " + AUC.format(name="roc_auc", t="scored"), "scored"))
def _(w):
    return E.roc_auc(evaluation(w))


@query("average_precision", sql(f"SELECT * FROM {AP}", "scored", extra=cum("scored")))
def _(w):
    return rounded(E.average_precision(evaluation(w)), 9, "pr_auc")


@query("brier_score", sql("SELECT * FROM " + BRIER.format(t="scored"), "scored"))
def _(w):
    return E.brier_score(evaluation(w))


@query("threshold_metrics", sql("SELECT * FROM " + at_threshold("scored", 0.5), "scored"))
def _(w):
    return E.threshold_metrics(evaluation(w))


@query("confusion_matrix", sql(" UNION ALL ".join(
    f"SELECT model_name, '{cell}' AS cell, count(*) FILTER (y = {y} AND p {op} 0.5) AS n FROM scored GROUP BY model_name"
    for cell, y, op in [("TN", 0, "<"), ("FP", 0, ">="), ("FN", 1, "<"), ("TP", 1, ">=")]), "scored"))
def _(w):
    return E.confusion_matrix(evaluation(w))


@query("roc_points", sql("""
    SELECT model_name, p AS threshold, CAST(cum_n - tp AS DOUBLE) / (total - positives) AS fpr,
           CAST(tp AS DOUBLE) / positives AS tpr FROM cum
    UNION ALL SELECT DISTINCT model_name, CAST(NULL AS DOUBLE), 0.0e0, 0.0e0 FROM cum""", "scored", extra=cum("scored")))
def _(w):
    return E.roc_points(evaluation(w))


@query("pr_points", sql("""
    SELECT model_name, p AS threshold, CAST(tp AS DOUBLE) / cum_n AS precision, CAST(tp AS DOUBLE) / positives AS recall
    FROM cum UNION ALL SELECT DISTINCT model_name, CAST(NULL AS DOUBLE), 1.0e0, 0.0e0 FROM cum""", "scored",
                        extra=cum("scored")))
def _(w):
    return E.pr_points(evaluation(w))


_bin = " + ".join(f"CAST(e[{i}] < p AS INTEGER)" for i in range(1, 10))


@query("calibration_table", sql(f"""
    SELECT model_name, CAST(bin AS INTEGER) AS bin, count(*) AS n,
           {ratio('sum(CAST(p AS DECIMAL(9,5)))', 'count(*)')} AS mean_predicted, {ratio('sum(y)', 'count(*)')} AS observed_rate
    FROM (SELECT s.*, {_bin} AS bin FROM scored s JOIN (
            SELECT model_name, quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
            FROM scored GROUP BY model_name) USING (model_name))
    GROUP BY model_name, bin""", "scored"))
def _(w):
    return E.calibration_table(evaluation(w))


@query("top_decile_lift", sql("SELECT * FROM " + LIFT.format(t="scored"), "scored"))
def _(w):
    return E.top_decile_lift(evaluation(w))


@query("cumulative_gains", sql("""
    SELECT model_name, CAST(step AS INTEGER) AS step, step / 100.0e0 AS share_contacted,
           CAST(n * step // 100 AS BIGINT) AS contacted,
           CAST(sum(y) FILTER (rn <= n * step // 100) AS DOUBLE) / sum(y) AS share_reached
    FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY p DESC, md5('lift:' || customer_id), customer_id) AS rn,
                 count(*) OVER (PARTITION BY model_name) AS n FROM scored), range(1, 101) g(step)
    GROUP BY model_name, step, n""", "scored"))
def _(w):
    return E.cumulative_gains(evaluation(w))


SAVED = "sum(monthly_charges) FILTER (y = 1 AND {c})"


def profit(cond):
    return (f"0.3e0 * 8 * coalesce({dbl(SAVED.format(c=cond))}, 0) - 50.0e0 * count(*) FILTER ({cond})")


@query("expected_profit", sql(f"""
    SELECT model_name, 0.4e0 AS threshold, count(*) FILTER (p >= 0.4) AS contacted, {profit('p >= 0.4')} AS profit
    FROM scored GROUP BY model_name""", "scored"))
def _(w):
    return E.expected_profit(evaluation(w), 0.40)


def curve_sql(t):
    return {"curve": f"""
        SELECT model_name, k / 100.0e0 AS threshold, {profit('p >= k / 100.0e0')} AS profit,
               {ratio('count(*) FILTER (p >= k / 100.0e0)', 'count(*)')} AS targeted_pct
        FROM {t}, range(5, 91) g(k) GROUP BY model_name, k"""}


@query("profit_curve", sql("SELECT * FROM curve", "scored", extra=curve_sql("scored")))
def _(w):
    return E.profit_curve(evaluation(w))


_best = "(SELECT model_name, min(threshold) AS threshold, max(profit) AS profit FROM curve c WHERE profit = " \
        "(SELECT max(profit) FROM curve d WHERE d.model_name = c.model_name) GROUP BY model_name)"


@query("best_threshold", sql(f"SELECT * FROM {_best}", "scored", extra=curve_sql("scored")))
def _(w):
    return E.best_threshold(E.profit_curve(evaluation(w)))


_campaign = f"""(SELECT model_name, threshold, {profit('p >= threshold')} AS campaign_value, {profit('true')} AS contact_all_value
    FROM test JOIN (SELECT model_name, threshold FROM {_best}) USING (model_name) GROUP BY model_name, threshold)"""


@query("campaign_vs_contact_all", sql(f"SELECT * FROM {_campaign}", "scored", extra={**TEST, **curve_sql("valid")}))
def _(w):
    rows = evaluation(w)
    return E.campaign_vs_contact_all(rows.where(F.col("split") == "valid"), rows.where(F.col("split") == "test"))


@query("campaign_simulator", sql(f"""
    SELECT customers, contacted, hits, churners, coalesce({ratio('hits', 'churners')}, 0) AS recall,
           coalesce({ratio('hits', 'contacted')}, 0) AS precision, contacted * 50.0e0 AS cost,
           0.3e0 * 8 * c AS revenue_retained, 0.3e0 * 8 * c - contacted * 50.0e0 AS net_value,
           coalesce((0.3e0 * 8 * c - contacted * 50.0e0) / nullif(contacted * 50.0e0, 0), 0) AS roi
    FROM (SELECT count(*) AS customers, count(*) FILTER (p >= 0.4) AS contacted,
                 count(*) FILTER (p >= 0.4 AND y = 1) AS hits, count(*) FILTER (y = 1) AS churners,
                 coalesce({dbl(SAVED.format(c='p >= 0.4'))}, 0) AS c
          FROM best WHERE split = 'test')""", "best"))
def _(w):
    return E.campaign_simulator(evaluation(w).where(F.col("model_name") == "scorecard"), 0.40)


_metrics = (" FROM " + AUC.format(name="roc_auc", t="test") + " JOIN " + AP + " USING (model_name) JOIN "
            + BRIER.format(t="test") + " USING (model_name) JOIN " + at_threshold("test", 0.5)
            + " USING (model_name) JOIN " + LIFT.format(t="test") + " USING (model_name)")


@query("classification_metrics", sql("SELECT *" + _metrics, "scored", extra={**TEST, **cum("test")}))
def _(w):
    return rounded(E.classification_metrics(evaluation(w).where(F.col("split") == "test")), 9, "pr_auc")


@query("model_comparison", sql(
    "SELECT *" + _metrics + " JOIN " + AUC.format(name="valid_roc_auc", t="valid") + " USING (model_name)",
    "scored", extra={**TEST, **cum("test")}))
def _(w):
    return rounded(E.model_comparison(evaluation(w)), 9, "pr_auc")


@query("select_best_model", sql(
    "SELECT * FROM " + AUC.format(name="valid_roc_auc", t="valid") + " ORDER BY valid_roc_auc DESC, model_name LIMIT 1",
    "scored", extra=TEST))
def _(w):
    return E.select_best_model(E.model_comparison(evaluation(w)).select("model_name", "valid_roc_auc"))


@query("run_summary", sql(f"""
    SELECT model_name AS best_model, c.threshold, roc_auc,
           (SELECT coalesce({ratio('count(*) FILTER (y = 1)', 'count(*)')}, 0) FROM test x
            WHERE x.model_name = c.model_name AND x.p >= c.threshold) AS precision,
           (SELECT {ratio('count(*) FILTER (x.p >= c.threshold)', 'count(*)')} FROM test x
            WHERE x.model_name = c.model_name AND y = 1) AS recall, campaign_value, contact_all_value
    FROM {_campaign} c JOIN {AUC.format(name='roc_auc', t='test')} a USING (model_name)
    WHERE model_name = (SELECT model_name FROM {AUC.format(name='v', t='valid')} ORDER BY v DESC, model_name LIMIT 1)""",
    "scored", extra={**TEST, **curve_sql("valid")}))
def _(w):
    return E.run_summary(evaluation(w)).drop("summary")


@query("run_summary_json", sql(f"""
    SELECT best_model, round(threshold, 6) AS threshold, round(roc_auc, 6) AS roc_auc, round(campaign_value, 2) AS campaign_value
    FROM ({all_oracles()["run_summary"]})"""))
def _(w):
    """The JSON text parsed again."""
    one = E.run_summary(evaluation(w)).select(F.from_json(
        "summary", "best_model string, threshold double, roc_auc double, campaign_value double").alias("s")).select("s.*")
    return one.select("best_model", F.round("threshold", 6).alias("threshold"), F.round("roc_auc", 6).alias("roc_auc"),
                      F.round("campaign_value", 2).alias("campaign_value"))


@query("risk_tier", sql("SELECT customer_id, model_name, risk_tier FROM scored", "scored"))
def _(w):
    return w.scored().select("customer_id", "model_name", "risk_tier")


@query("score_extract", sql(
    "SELECT customer_id, model_name, p AS churn_probability, risk_tier, split, targeted FROM best", "best"))
def _(w):
    return w.best_scores().drop("scored_at")


@query("all_model_scores", sql("SELECT customer_id, model_name, p AS churn_probability, risk_tier FROM scored", "scored"))
def _(w):
    mart = w.mart()
    frames = [scoring.score_rows(mart, "scorecard", scoring.score_points() / scoring.MAX_POINTS),
              scoring.score_rows(mart, "scorecard_tenure", scoring.tenure_points() / scoring.TENURE_CAP)]
    return scoring.all_model_scores(frames).drop("scored_at")


CARD_FEATURES = ["contract_type", "tenure", "internet_service", "payment_method", "noise"]


def card_rows(w):
    return w.mart().select("customer_id", F.col("churn").alias("y"), "contract_type", "tenure", "internet_service",
                           "payment_method", scoring.key_points().alias("noise"))


def card_predict(df):
    points = scoring.score_points(noise=F.col("noise"))
    return df.withColumn("p", half_up(points / scoring.MAX_POINTS, 5))


_points = """CASE contract_type WHEN 'Month-to-month' THEN 30 WHEN 'One year' THEN 10 ELSE 0 END
    + 60 - least(tenure, 60) + CASE WHEN internet_service = 'Fiber optic' THEN 10 ELSE 0 END
    + CASE WHEN payment_method = 'Electronic check' THEN 15 ELSE 0 END + noise"""


def _shuffled():
    tests = ", ".join(f"('{f}', {rep}, {E.shift_of(42, i, rep)})" for i, f in enumerate(CARD_FEATURES) for rep in range(1, 6))
    swapped = ", ".join(f"CASE WHEN f = '{c}' THEN d.{c} ELSE a.{c} END AS {c}" for c in CARD_FEATURES)
    return {
        "card": """SELECT customer_id, churn AS y, contract_type, tenure, internet_service, payment_method,
                          CAST(customer_id AS BIGINT) % 25 AS noise,
                          row_number() OVER (ORDER BY md5('42:' || customer_id), customer_id) - 1 AS i, count(*) OVER () AS n
                   FROM mart""",
        "tests": f"SELECT * FROM (VALUES {tests}) AS t(f, rep, shift)",
        "mixed": f"""SELECT f, rep, a.y, {swapped} FROM card a CROSS JOIN tests
                     JOIN card d ON d.i = (a.i + 1 + shift % (a.n - 1)) % a.n""",
        "ranked": f"""SELECT f, rep, y, rank() OVER (PARTITION BY f, rep ORDER BY pt)
                             + (count(*) OVER (PARTITION BY f, rep, pt) - 1) / 2.0e0 AS rk
                      FROM (SELECT *, {_points} AS pt FROM mixed
                            UNION ALL SELECT 'base', 0, y, contract_type, tenure, internet_service, payment_method, noise,
                                             {_points} FROM card)""",
        "aucs": """SELECT f, rep, (sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0e0)
                          / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS auc FROM ranked GROUP BY f, rep""",
    }


_imp = f"""SELECT f AS feature, {r("avg((SELECT auc FROM aucs WHERE f = 'base') - auc)", 9)} AS auc_drop,
    {r("stddev_pop((SELECT auc FROM aucs WHERE f = 'base') - auc)", 9)} AS std FROM aucs WHERE f <> 'base' GROUP BY f"""


@query("permutation_importance", sql(_imp, "mart", extra=_shuffled()))
def _(w):
    return rounded(E.permutation_importance(card_rows(w), CARD_FEATURES, card_predict), 9, "auc_drop", "std")


@query("top_features", sql(f"SELECT * FROM ({_imp}) ORDER BY auc_drop DESC, feature LIMIT 3", "mart", extra=_shuffled()))
def _(w):
    imp = rounded(E.permutation_importance(card_rows(w), CARD_FEATURES, card_predict), 9, "auc_drop", "std")
    return E.top_features(imp, 3)


# ---------------------------------------------------------------- measures
_gone = "count(*) FILTER (churn = 1)"
_base = f"""count(*) AS customers, {_gone} AS churned_customers, count(*) - {_gone} AS active_customers,
    {ratio(_gone, 'count(*)')} AS churn_rate, 1.0e0 - {ratio(_gone, 'count(*)')} AS retention_rate,
    {dbl('sum(monthly_charges)')} AS mrr, coalesce({dbl('sum(monthly_charges) FILTER (churn = 1)')}, 0) AS mrr_lost,
    coalesce({ratio('sum(monthly_charges) FILTER (churn = 1)', 'sum(monthly_charges)')}, 0) AS mrr_lost_pct,
    coalesce({dbl('12 * sum(monthly_charges) FILTER (churn = 1)')}, 0) AS annualised_revenue_lost,
    {ratio('sum(monthly_charges)', 'count(*)')} AS arpu,
    {ratio('sum(monthly_charges) FILTER (churn = 1)', _gone)} AS arpu_churned,
    {ratio('sum(monthly_charges) FILTER (churn = 0)', 'count(*) FILTER (churn = 0)')} AS arpu_retained,
    {dbl('sum(total_charges)')} AS lifetime_revenue, {ratio('sum(tenure)', 'count(*)')} AS avg_tenure"""


@query("measures_base", sql(f"""
    SELECT contract_type, internet_service, {_base} FROM mart GROUP BY contract_type, internet_service""", "mart"))
def _(w):
    return M.measure(w.customer_360(), M.BASE, ["contract_type", "internet_service"])


@query("measures_base_filtered", sql(f"SELECT {_base} FROM mart WHERE tenure >= 12 AND gender = 'Female'", "mart"))
def _(w):
    return M.measure(w.customer_360(), M.BASE, where=(F.col("tenure") >= 12) & (F.col("gender") == "Female"))


@query("measures_compare", sql(f"""
    SELECT contract_type, internet_service, customers, churn_rate,
           (churn_rate - (SELECT {ratio(_gone, 'count(*)')} FROM mart)) * 100 AS churn_rate_vs_overall,
           CAST(dense_rank() OVER (ORDER BY churn_rate DESC) AS INTEGER) AS churn_rate_rank,
           {ratio('lost', 'sum(lost) OVER ()')} AS share_of_mrr_lost
    FROM (SELECT contract_type, internet_service, count(*) AS customers, {ratio(_gone, 'count(*)')} AS churn_rate,
                 coalesce(sum(monthly_charges) FILTER (churn = 1), 0) AS lost
          FROM mart GROUP BY contract_type, internet_service)""", "mart"))
def _(w):
    return M.compare_measures(w.customer_360(), ["contract_type", "internet_service"])


@query("measures_cumulative", sql(f"""
    SELECT tenure_band, CAST(row_number() OVER (ORDER BY b) AS INTEGER) AS band_order, {dbl('lost')} AS mrr_lost,
           {ratio('sum(lost) OVER (ORDER BY b)', 'sum(lost) OVER ()')} AS cumulative_mrr_lost_pct
    FROM (SELECT tenure_band, min(tenure) AS b, coalesce(sum(monthly_charges) FILTER (churn = 1), 0) AS lost
          FROM mart GROUP BY tenure_band)""", "mart"))
def _(w):
    from tenura.operators.star import dim_tenure_band
    return M.cumulative_mrr_lost(w.customer_360(), dim_tenure_band(w.spark))


def _rate_having(status, service=""):
    return f"""SELECT count(*) AS customers, {ratio('sum(churn)', 'count(*)')} AS churn_rate FROM mart
        WHERE customer_id IN (SELECT customer_id FROM bridge WHERE status = '{status}' {service})"""


@query("rate_with_service", sql(_rate_having("Yes", "AND service_name = 'tech_support'"), "mart", "bridge"))
def _(w):
    from tenura.operators.star import unpivot_addons
    return M.rate_with_service(w.customer_360(), unpivot_addons(w.features()), "tech_support")


@query("rate_without_service", sql(_rate_having("No"), "mart", "bridge"))
def _(w):
    from tenura.operators.star import unpivot_addons
    return M.rate_without_service(w.customer_360(), unpivot_addons(w.features()))


_adopt = ratio("count(*) FILTER (status = 'Yes')", "count(*) FILTER (status <> 'No internet service')")


@query("measures_addons", sql(f"""
    SELECT service_name, {_adopt} AS adoption,
           {ratio("sum(churn) FILTER (status = 'Yes')", "count(*) FILTER (status = 'Yes')")} AS rate_with,
           {ratio("sum(churn) FILTER (status = 'No')", "count(*) FILTER (status = 'No')")} AS rate_without
    FROM bridge JOIN mart USING (customer_id) GROUP BY service_name
    UNION ALL SELECT 'any', (SELECT {_adopt} FROM bridge), (SELECT churn_rate FROM ({_rate_having('Yes')})),
                     (SELECT churn_rate FROM ({_rate_having('No')}))""", "mart", "bridge"))
def _(w):
    return M.addon_measures(w.mart())


_dp = "CAST(p AS DECIMAL(9,5))"


@query("measures_scores", sql(f"""
    SELECT contract_type, {ratio(f'sum({_dp})', 'count(*)')} AS avg_churn_probability, {dbl(f'sum({_dp})')} AS expected_churners,
           {dbl(f'sum({_dp} * CAST(b.monthly_charges AS DECIMAL(18,2)))')} AS expected_mrr_at_risk,
           count(*) FILTER (risk_tier IN ('High', 'Critical')) AS high_risk_customers,
           count(*) FILTER (risk_tier IN ('High', 'Critical') AND y = 0) AS high_risk_active_customers,
           count(*) FILTER (targeted = 1) AS targeted_customers,
           {ratio("count(*) FILTER (split = 'test' AND targeted = 1 AND y = 1)", "count(*) FILTER (split = 'test' AND targeted = 1)")} AS campaign_precision_test,
           {ratio("count(*) FILTER (split = 'test' AND targeted = 1 AND y = 1)", "count(*) FILTER (split = 'test' AND y = 1)")} AS campaign_recall_test
    FROM best b JOIN mart USING (customer_id) GROUP BY contract_type""", "best", "mart"))
def _(w):
    return M.measure(M.with_scores(w.customer_360(), w.best_scores()), M.SCORES, ["contract_type"])


_whatif = {"per": f"""SELECT k / 100.0e0 AS threshold, count(*) FILTER (p >= k / 100.0e0) AS contacted,
        coalesce({dbl(SAVED.format(c='p >= k / 100.0e0'))}, 0) AS charges FROM best, range(5, 96) g(k) GROUP BY k""",
           "grid": """SELECT threshold, c * 1.0e0 AS offer_cost, a / 20.0e0 AS acceptance, CAST(m AS INTEGER) AS months, contacted,
        contacted * (c * 1.0e0) AS cost, charges * (a / 20.0e0) * m AS revenue_saved
        FROM per, range(10, 151, 5) x(c), range(1, 13) y(a), range(1, 25) z(m)"""}


@query("campaign_what_if", sql("""
    SELECT *, revenue_saved - cost AS net_value, (revenue_saved - cost) / nullif(cost, 0) AS roi FROM grid""",
                                "best", extra=_whatif))
def _(w):
    """Every combination of threshold, offer cost, acceptance and months."""
    return M.campaign_what_if(evaluation(w).where(F.col("model_name") == "scorecard"))


@query("campaign_what_if_best", sql("""
    SELECT offer_cost, acceptance, months, max(net) AS net_value, min(threshold) FILTER (net = top) AS threshold
    FROM (SELECT *, revenue_saved - cost AS net,
                 max(revenue_saved - cost) OVER (PARTITION BY offer_cost, acceptance, months) AS top FROM grid)
    GROUP BY offer_cost, acceptance, months""", "best", extra=_whatif))
def _(w):
    """Best threshold for every slider combination of the full grid."""
    grid = M.campaign_what_if(evaluation(w).where(F.col("model_name") == "scorecard"))
    best = F.max(F.struct("net_value", (-F.col("threshold")).alias("minus"))).alias("b")
    return grid.groupBy("offer_cost", "acceptance", "months").agg(best).select(
        "offer_cost", "acceptance", "months", "b.net_value", (-F.col("b.minus")).alias("threshold"))


@query("measure_labels", sql(f"""
    SELECT contract_type, CASE WHEN rate >= 0.4 THEN '#B8431D' WHEN rate >= 0.25 THEN '#EB6834' WHEN rate >= 0.15 THEN '#F5B394'
                               ELSE '#9CC2EF' END AS churn_rate_colour,
           format('{{:,}}', n) || ' customers · ' || printf('%.1f', {r('100.0e0 * rate', 1)}) || '% churn · $'
           || format('{{:,}}', CAST({r('lost', 0)} AS BIGINT)) || ' MRR lost' AS kpi_subtitle
    FROM (SELECT contract_type, count(*) AS n, {ratio(_gone, 'count(*)')} AS rate,
                 coalesce(sum(monthly_charges) FILTER (churn = 1), 0) AS lost FROM mart GROUP BY contract_type)""", "mart"))
def _(w):
    return M.measure_labels(w.customer_360(), ["contract_type"])


@query("call_list", sql(f"""
    SELECT customer_id, m.contract_type, {dbl('m.monthly_charges')} AS monthly_charges, b.p AS churn_probability, b.risk_tier,
           {dbl(f'{_dp} * CAST(m.monthly_charges AS DECIMAL(18,2))')} AS expected_loss
    FROM best b JOIN mart m USING (customer_id) WHERE m.churn = 0 AND risk_tier IN ('High', 'Critical')
    ORDER BY expected_loss DESC, customer_id LIMIT 100""", "best", "mart"))
def _(w):
    out = M.call_list(w.customer_360(), w.best_scores(), 100)
    return out.withColumn("monthly_charges", F.col("monthly_charges").cast("double"))


# ---------------------------------------------------------------- segments on a fixed label
_z = ", ".join(
    r("(CAST({e} AS DOUBLE) - avg(CAST({e} AS DOUBLE)) OVER ()) / stddev_pop(CAST({e} AS DOUBLE)) OVER ()".format(
        e="ln(1 + CAST(contract_months AS DOUBLE))" if c == "contract_months" else c), 6) + f" AS z_{c}"
    for c in D.SEGMENT_FEATURES)


@query("segment_features", sql(f"SELECT customer_id, {_z} FROM mart", "mart"))
def _(w):
    return rounded(segments.segment_features(w.mart()).select("customer_id", *segments.SCALED), 6, *segments.SCALED)


_means = ", ".join(f"{ratio(f'sum({c})', 'count(*)')} AS {c}" for c in D.SEGMENT_FEATURES)
_seg = {"profile": f"""SELECT segment_id, count(*) AS customers, {ratio('sum(churn)', 'count(*)')} AS churn_rate, {_means}
                       FROM seg GROUP BY segment_id""",
        "overall": f"SELECT {', '.join(f'{ratio(f'sum({c})', 'count(*)')} AS {c}' for c in D.SEGMENT_FEATURES)} FROM seg",
        "named": """SELECT p.*, CASE WHEN p.tenure < o.tenure * 0.6 THEN 'New' WHEN p.tenure > o.tenure * 1.3 THEN 'Loyal'
                        ELSE 'Mid-life' END || ', ' || CASE WHEN p.contract_months < 4 THEN 'month-to-month'
                        WHEN p.contract_months > 12 THEN 'long contract' ELSE 'mixed contract' END || ', ' ||
                        CASE WHEN p.has_internet < 0.2 THEN 'phone-only' WHEN p.n_addons > o.n_addons * 1.3 THEN 'bundled'
                        WHEN p.monthly_charges > o.monthly_charges * 1.15 THEN 'high spend' ELSE 'core internet' END AS segment_name
                    FROM profile p, overall o""",
        "once": """SELECT * REPLACE (CASE WHEN count(*) OVER (PARTITION BY segment_name) > 1 THEN segment_name ||
                        CASE WHEN auto_pay >= 0.5 THEN ', auto-pay' ELSE ', manual pay' END ELSE segment_name END AS segment_name)
                   FROM named""",
        "final": """SELECT * REPLACE (CASE WHEN count(*) OVER (PARTITION BY segment_name) > 1 THEN segment_name || ' #' || segment_id
                        ELSE segment_name END AS segment_name) FROM once"""}


@query("segment_profile", sql("SELECT * FROM profile", "seg", extra=_seg))
def _(w):
    return segments.segment_profile(w.segments())


@query("segment_names", sql("SELECT segment_id, segment_name FROM named", "seg", extra=_seg))
def _(w):
    seg = w.segments()
    return segments.segment_names(segments.segment_profile(seg), seg).select("segment_id", "segment_name")


@query("disambiguate_names", sql("SELECT segment_id, segment_name FROM final", "seg", extra=_seg))
def _(w):
    return segments.name_segments(w.segments()).select("segment_id", "segment_name")
