"""Queries that go through files: written below the shared folder, read back, compared."""

from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.functions.numeric import half_up
from tenura.operators import breakdowns as B
from tenura.operators import models
from tenura.plans import breakdowns_q  # noqa: F401  its check SQL is used here
from tenura.plans.catalog import all_oracles, query
from tenura.plans.check_sql import dbl, r, ratio, sql
from tenura.plans.models_q import fitted, rows_of
from tenura.session import work_folder
from tenura.sources import files

_raw_list = ", ".join(f'"{c}"' for c in D.RAW_COLUMNS)


@query("read_raw_subscriptions", sql(f"SELECT {_raw_list} FROM raw", "raw"))
def _(w):
    path = work_folder(w.spark, "extract")
    w.raw().write.option("header", True).option("ignoreTrailingWhiteSpace", False) \
        .option("ignoreLeadingWhiteSpace", False).csv(path)
    return files.read_raw_subscriptions(w.spark, path)


@query("table_fingerprint", sql("""
    SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)) * 4294967296
               + sum(CAST('0x' || substr(h, 9, 8) AS BIGINT)) AS VARCHAR) || '-'
           || CAST(sum(CAST('0x' || substr(h, 17, 8) AS BIGINT)) * 4294967296
               + sum(CAST('0x' || substr(h, 25, 8) AS BIGINT)) AS VARCHAR) AS fingerprint
    FROM (SELECT md5(""" + " || ".join(f"""coalesce(length("{c}") || ':' || "{c}", '-')""" for c in sorted(D.RAW_COLUMNS))
    + """) AS h FROM raw)""", "raw"))
def _(w):
    return files.table_fingerprint(w.raw())


@query("write_clean", sql(f"SELECT customer_id, tenure, {dbl('monthly_charges')} AS monthly_charges, churn FROM feat", "feat"))
def _(w):
    path = work_folder(w.spark, "clean")
    files.write_clean(w.features(), path)
    return w.spark.read.parquet(path).select(
        "customer_id", "tenure", F.col("monthly_charges").cast("double").alias("monthly_charges"), "churn")


def _written_star(w):
    folder = work_folder(w.spark, "star")
    files.write_star(w.star(), folder)
    return folder


@query("write_star", sql("""
    SELECT 'dim_contract' AS table_name, count(DISTINCT contract) AS n FROM feat
    UNION ALL SELECT 'dim_payment', count(DISTINCT payment_method) FROM feat
    UNION ALL SELECT 'dim_internet', count(DISTINCT internet_service) FROM feat
    UNION ALL SELECT 'dim_tenure_band', 6 FROM (SELECT count(*) FROM feat)
    UNION ALL SELECT unnest(['dim_customer', 'fact_subscription']), count(*) FROM feat
    UNION ALL SELECT 'bridge_customer_service', 6 * count(*) FROM feat""", "feat"))
def _(w):
    folder = _written_star(w)
    out = None
    for name in w.star():
        one = files.read_table(w.spark, folder, name).agg(F.count("*").alias("n")) \
            .select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("read_table", sql(f"""
    SELECT gender, count(*) AS customers, {dbl('sum(monthly_charges)')} AS mrr FROM feat WHERE tenure >= 24
    GROUP BY gender""", "feat"))
def _(w):
    """Parameterised SQL over two written tables."""
    folder = _written_star(w)
    tables = {n: files.read_table(w.spark, folder, n) for n in ("fact_subscription", "dim_customer")}
    return files.query(w.spark, """
        SELECT c.gender, count(*) AS customers, CAST(sum(f.monthly_charges) AS DOUBLE) AS mrr
        FROM fact_subscription f JOIN dim_customer c ON c.customer_id = f.customer_id
        WHERE f.tenure >= :from_month GROUP BY c.gender""", tables, from_month=24)


@query("write_scores", sql("""
    SELECT model_name, count(*) AS n, sum(CAST(CASE WHEN model_name = 'scorecard' THEN 1 - p ELSE p END
                                               AS DECIMAL(9,5))) :: DOUBLE AS total
    FROM scored GROUP BY model_name""", "scored"))
def _(w):
    """Two models are written, then one of them again with other values: the other one stays."""
    path = work_folder(w.spark, "scores")
    files.write_scores(w.model_scores(), path)
    again = w.model_scores().where(F.col("model_name") == "scorecard").withColumn(
        "churn_probability", 1 - F.col("churn_probability"))
    files.write_scores(again, path)
    return w.spark.read.parquet(path).groupBy("model_name").agg(
        F.count("*").alias("n"),
        F.sum(F.col("churn_probability").cast("decimal(9,5)")).cast("double").alias("total"))


# label columns and numbers of the seven questions
QUESTIONS = {
    "churn_by_contract": (["contract_type", "internet_service"],
                          ["customers", "churned", "churn_rate_pct", "avg_monthly_charge", "mrr", "mrr_lost"]),
    "revenue_at_risk": (["segment"], ["churned", "mrr_lost", "pct_of_total_loss", "cumulative_pct", "loss_rank"]),
    "tenure_cohorts": (["tenure_band"], ["min_tenure", "customers", "churn_rate_pct", "avg_monthly_charge", "avg_services",
                                         "pct_month_to_month"]),
    "addon_impact": (["service_name"], ["churn_with_pct", "churn_without_pct", "churn_gap_pts", "adopters", "adoption_pct"]),
    "payment_billing": (["payment_method", "billing"], ["customers", "churn_rate_pct", "avg_tenure"]),
    "high_value_at_risk": (["contract_type", "internet_service"],
                           ["top_quartile_customers", "churned", "churn_rate_pct", "annualised_revenue_lost"]),
    "model_risk_tiers": (["model_name", "risk_tier"], ["customers", "avg_predicted", "actual_rate", "mrr_in_tier"]),
}
_insights = " UNION ALL ".join(
    f"SELECT '{name}' AS question, concat_ws('|', {', '.join(labels)}) AS row_label, '{c}' AS column_name, "
    f"{r(c, 6)} AS value FROM ({all_oracles()[name]}) q"
    for name, (labels, numbers) in QUESTIONS.items() for c in numbers)


@query("write_insights", _insights)
def _(w):
    """All seven questions written, read back and laid out cell by cell; an eighth one has no rows and is skipped."""
    folder = work_folder(w.spark, "insights")
    c360 = w.customer_360()
    results = {
        "churn_by_contract": B.churn_by_contract(c360), "revenue_at_risk": B.revenue_at_risk(c360),
        "tenure_cohorts": B.tenure_cohorts(c360), "addon_impact": B.addon_impact(w.mart()),
        "payment_billing": B.payment_billing(c360), "high_value_at_risk": B.high_value_at_risk(c360),
        "model_risk_tiers": B.model_risk_tiers(w.model_scores(), c360),
        "nobody": B.churn_by_contract(c360.where(F.col("tenure") < 0))}
    out = None
    for name in files.write_insights(results, folder):
        labels, numbers = QUESTIONS[name]
        cells = w.spark.read.option("header", True).csv(f"{folder}/{name}").select(
            F.lit(name).alias("question"), F.concat_ws("|", *labels).alias("row_label"),
            *[half_up(c, 6).alias(c) for c in numbers]).unpivot(["question", "row_label"], numbers, "column_name", "value")
        out = cells if out is None else out.unionByName(cells)
    return out


def _bi_folder(w):
    folder = work_folder(w.spark, "bi")
    scores = w.best_scores().withColumn("scored_at", F.date_format("scored_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    named = w.segments().withColumn("segment_name", F.concat(F.lit("segment "), F.col("segment_id")))
    files.export_bi(files.bi_tables(w.star(), scores, named), folder)
    return folder


@query("export_bi", sql("""
    SELECT unnest(['dim_customer', 'fact_subscription', 'fact_churn_score', 'dim_segment']) AS table_name, count(*) AS n FROM feat
    UNION ALL SELECT 'dim_contract', count(DISTINCT contract) FROM feat
    UNION ALL SELECT 'dim_payment', count(DISTINCT payment_method) FROM feat
    UNION ALL SELECT 'dim_internet', count(DISTINCT internet_service) FROM feat
    UNION ALL SELECT 'dim_tenure_band', 6 FROM (SELECT count(*) FROM feat)
    UNION ALL SELECT 'bridge_customer_service', 6 * count(*) FROM feat""", "feat"))
def _(w):
    folder = _bi_folder(w)
    out = None
    for name in files.BI_TYPES:
        one = files.read_bi_extract(w.spark, folder, name).agg(F.count("*").alias("n")) \
            .select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("read_bi_extract", sql(f"""
    SELECT customer_id, CAST(tenure AS BIGINT) AS tenure, tenure_band, CAST(n_services AS BIGINT) AS n_services,
           {dbl('monthly_charges')} AS monthly_charges, {dbl('total_charges')} AS total_charges,
           {r('charge_drift', 6)} AS charge_drift, CASE churn WHEN 1 THEN 'Churned' ELSE 'Active' END AS status FROM feat""",
                             "feat"))
def _(w):
    fact = files.read_bi_extract(w.spark, _bi_folder(w), "fact_subscription")
    return fact.select("customer_id", "tenure", "tenure_band", "n_services",
                       F.col("monthly_charges").cast("double").alias("monthly_charges"),
                       F.col("total_charges").cast("double").alias("total_charges"),
                       half_up("charge_drift", 6).alias("charge_drift"), "status")


@query("read_bi_scores", sql(f"""
    SELECT risk_tier, CAST(CASE risk_tier WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 4 END AS INTEGER)
               AS tier_order, floor(p * 10) / 10 AS probability_bucket, count(*) AS n,
           {ratio('sum(targeted)', 'count(*)')} AS targeted_share
    FROM best GROUP BY ALL""", "best"))
def _(w):
    scores = files.read_bi_extract(w.spark, _bi_folder(w), "fact_churn_score")
    return scores.groupBy("risk_tier", "tier_order", "probability_bucket").agg(
        F.count("*").alias("n"),
        (F.sum("targeted").cast("double") / F.count("*").cast("double")).alias("targeted_share"))


# Key columns of each written table; every other column is compared cell by cell.
KEYS = {"dim_contract": ["contract_key"], "dim_payment": ["payment_key"], "dim_internet": ["internet_key"], "dim_tenure_band": ["tenure_band"],
        "dim_customer": ["customer_id"], "fact_subscription": ["customer_id"], "bridge_customer_service": ["customer_id", "service_name"],
        "fact_churn_score": ["customer_id", "model_name"], "dim_segment": ["customer_id"], "clean": ["customer_id"]}


def _cells(df, name):
    """Rows (table_name, row_key, column_name, value) of every column; doubles as decimals of six digits."""
    shown = {c: (half_up(c, 6).cast("decimal(28,6)") if t == "double" else
                 F.when(F.col(c).isNotNull(), "there") if t == "timestamp" else F.col(c)).cast("string")      # the time is that of the run
             for c, t in df.dtypes if c not in KEYS[name]}
    return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *KEYS[name]).alias("row_key"),
                     *[v.alias(c) for c, v in shown.items()]).unpivot(["table_name", "row_key"], list(shown), "column_name", "value")


def _all_cells(tables):
    out = None
    for name, df in tables.items():
        out = _cells(df, name) if out is None else out.unionByName(_cells(df, name))
    return out


def _cells_sql(name, source, columns, **other):
    """The same from the definitions: `columns` as they are, `other` by expression."""
    shown = {c: c for c in columns} | other
    names = ", ".join(f"'{c}'" for c in shown)
    values = ", ".join(f"CAST({v} AS VARCHAR)" for v in shown.values())
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in KEYS[name])
    return f"SELECT '{name}' AS table_name, {key} AS row_key, unnest([{names}]) AS column_name, unnest([{values}]) AS value FROM {source}"


def _six(expr):
    return f"CAST({r(expr, 6)} AS DECIMAL(28,6))"


_dims = {
    "contracts": "SELECT *, row_number() OVER (ORDER BY contract_type) AS contract_key FROM "
                 "(SELECT DISTINCT contract AS contract_type, contract_months FROM feat WHERE contract IS NOT NULL)",
    "payments": "SELECT *, row_number() OVER (ORDER BY payment_method) AS payment_key FROM "
                "(SELECT DISTINCT payment_method, auto_pay FROM feat WHERE payment_method IS NOT NULL)",
    "internets": "SELECT *, row_number() OVER (ORDER BY internet_service) AS internet_key FROM "
                 "(SELECT DISTINCT internet_service FROM feat WHERE internet_service IS NOT NULL)",
    "bands": "SELECT unnest([" + ", ".join(f"'{b}'" for b, _ in D.TENURE_BANDS) + "]) AS tenure_band, "
             f"unnest(range(1, {len(D.TENURE_BANDS) + 1})) AS band_order",
    "facts": "SELECT f.*, contract_key, payment_key, internet_key FROM feat f LEFT JOIN contracts c ON f.contract = c.contract_type "
             "LEFT JOIN payments p ON f.payment_method = p.payment_method LEFT JOIN internets i ON f.internet_service = i.internet_service",
}
_fact_columns = ["contract_key", "payment_key", "internet_key", "tenure", "tenure_band", "phone_service", "multiple_lines",
                 "paperless_billing", "n_addons", "n_services", "monthly_charges", "total_charges", "churn"]
_customer_columns = ["gender", "senior_citizen", "partner", "dependents", "family"]


def _star_sql(derived):
    """Cells of the star; with the columns that the BI layer derives, where asked for."""
    def more(**columns):
        return columns if derived else {}
    return [
        _cells_sql("dim_contract", "contracts", ["contract_type", "contract_months"]),
        _cells_sql("dim_payment", "payments", ["payment_method", "auto_pay"], **more(payment_short="split_part(payment_method, ' (', 1)")),
        _cells_sql("dim_internet", "internets", ["internet_service"]),
        _cells_sql("dim_tenure_band", "bands", ["band_order"]),
        _cells_sql("dim_customer", "feat", _customer_columns, **more(
            age_group="CASE senior_citizen WHEN 1 THEN 'Senior' ELSE 'Under 65' END",
            household="CASE 2 * partner + dependents WHEN 3 THEN 'Partner + dependents' WHEN 2 THEN 'Partner' WHEN 1 THEN 'Dependents' "
                      "ELSE 'Single' END")),
        _cells_sql("fact_subscription", "facts", _fact_columns, charge_drift=_six("charge_drift"), **more(
            status="CASE churn WHEN 1 THEN 'Churned' ELSE 'Active' END")),
        _cells_sql("bridge_customer_service", "bridge", ["status"], **more(
            service="list_aggregate(list_transform(string_split(service_name, '_'), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ')")),
    ]


@query("write_clean_cells", sql(_cells_sql(
    "clean", "feat", ["gender", "senior_citizen", "partner", "dependents", "tenure", "phone_service", "multiple_lines", "internet_service",
                      *D.ADDONS, "contract", "paperless_billing", "payment_method", "monthly_charges", "total_charges", "churn",
                      "has_internet", "multiple_lines_flag", "n_addons", "has_protection_bundle", "auto_pay", "contract_months", "tenure_band", "is_new_customer",
                      "family", "fiber_no_support", "n_services"],
    **{c: _six(c) for c in ("avg_historic_charge", "charge_drift", "charge_per_service")}), "feat"))
def _(w):
    """Every column of the clean frame, written and read back."""
    path = work_folder(w.spark, "clean")
    files.write_clean(w.features(), path)
    return _cells(w.spark.read.parquet(path), "clean")


@query("write_star_cells", sql(" UNION ALL ".join(_star_sql(False)), "feat", "bridge", extra=_dims))
def _(w):
    """Every cell of the seven written tables of the star."""
    folder = _written_star(w)
    return _all_cells({name: files.read_table(w.spark, folder, name) for name in w.star()})


@query("bi_extract_cells", sql(" UNION ALL ".join([
    *_star_sql(True),
    _cells_sql("dim_segment", "seg", ["segment_id"], segment_name="'segment ' || segment_id"),
    _cells_sql("fact_churn_score", "best", ["risk_tier", "split", "targeted"], churn_probability=_six("p"), scored_at="'there'",
               tier_order="CASE risk_tier WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 4 END",
               probability_bucket=_six("floor(p * 10) / 10")),
]), "feat", "bridge", "seg", "best", extra=_dims))
def _(w):
    """Every cell of the nine BI extracts, typed and with their derived columns."""
    folder = _bi_folder(w)
    return _all_cells({name: files.read_bi_extract(w.spark, folder, name) for name in files.BI_TYPES})


@query("save_model")
def _(w):
    """Scores of a saved and reloaded model beside the original's."""
    path = work_folder(w.spark, "model")
    model = fitted(w, "logistic_regression")
    models.save_model(model, path)
    rows = models.as_training(rows_of(w))
    before = models.with_probability(model, rows).select("customer_id", F.col("p").alias("p_before"))
    after = models.with_probability(models.load_model(path), rows).select("customer_id", F.col("p").alias("p_after"))
    return before.join(after, "customer_id").select("customer_id", "p_before", "p_after")
