"""Queries over the extract, the features and the star schema."""

from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.functions.numeric import half_up
from tenura.operators import ordering, star
from tenura.plans.catalog import query
from tenura.plans.check_sql import C360, dbl, r, sql


def doubles(df, *columns):
    """Money leaves as double: the exact decimal, converted once at the end."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_text = ", ".join(f'"{c}" AS {X.snake_name(c)}' for c in D.RAW_COLUMNS)


@query("trim_strings", sql(
    "SELECT " + ", ".join(f'trim("{c}") AS "{c}"' for c in D.RAW_COLUMNS) + " FROM raw", "raw"))
def _(w):
    return X.trim_strings(w.raw())


@query("snake_case_columns", sql(f"SELECT {_text} FROM raw", "raw"))
def _(w):
    return X.snake_case_columns(w.raw())


@query("cast_types", sql(
    f"SELECT customer_id, senior_citizen, tenure, {dbl('monthly_charges')} AS monthly_charges FROM cleaned",
    "cleaned"))
def _(w):
    typed = X.cast_types(X.trim_strings(X.snake_case_columns(w.raw())))
    return doubles(typed.select("customer_id", "senior_citizen", "tenure", "monthly_charges"),
                   "monthly_charges")


@query("impute_total_charges", sql(
    f"SELECT customer_id, tenure, {dbl('total_charges')} AS total_charges FROM cleaned", "cleaned"))
def _(w):
    filled = X.impute_total_charges(X.cast_types(X.trim_strings(X.snake_case_columns(w.raw()))))
    return doubles(filled.select("customer_id", "tenure", "total_charges"), "total_charges")


@query("binarise", sql(f"SELECT customer_id, {', '.join(D.YES_FLAGS)} FROM cleaned", "cleaned"))
def _(w):
    return X.binarise(X.trim_strings(X.snake_case_columns(w.raw()))).select("customer_id", *D.YES_FLAGS)


_feature_columns = ["customer_id", "has_internet", "multiple_lines_flag", "n_addons",
                    "has_protection_bundle", "n_services", "auto_pay", "contract_months",
                    "tenure_band", "is_new_customer", "family", "fiber_no_support"]
_charge_columns = ["avg_historic_charge", "charge_drift", "charge_per_service"]


@query("service_features", sql(f"SELECT {', '.join(_feature_columns)} FROM feat", "feat"))
def _(w):
    return w.features().select(*_feature_columns)


@query("charge_features", sql(
    "SELECT customer_id, " + ", ".join(f"{r(c, 6)} AS {c}" for c in _charge_columns)
    + f", {r('ln(1 + CAST(total_charges AS DOUBLE))', 6)} AS log_total_charges FROM feat", "feat"))
def _(w):
    df = X.log_total_charges(w.features())
    return df.select("customer_id", *[half_up(c, 6).alias(c) for c in [*_charge_columns, "log_total_charges"]])


for _name in _feature_columns[1:]:
    def _one(w, name=_name):
        return w.features().groupBy(F.col(name)).agg(
            F.count("*").alias("customers"), F.sum("churn").alias("churned"))
    query(_name, sql(f"SELECT {_name}, count(*) AS customers, CAST(sum(churn) AS BIGINT) AS churned "
                     f"FROM feat GROUP BY {_name}", "feat"))(_one)

for _name in [*_charge_columns, "log_total_charges"]:
    def _one(w, name=_name):
        return X.log_total_charges(w.features()).select("customer_id", half_up(name, 6).alias(name))
    _expr = "ln(1 + CAST(total_charges AS DOUBLE))" if _name == "log_total_charges" else _name
    query(_name, sql(f"SELECT customer_id, {r(_expr, 6)} AS {_name} FROM feat", "feat"))(_one)


@query("status", sql("""
    SELECT CASE churn WHEN 1 THEN 'Churned' ELSE 'Active' END AS status, count(*) AS customers
    FROM feat GROUP BY 1""", "feat"))
def _(w):
    return w.fact().groupBy(X.status(F.col("churn")).alias("status")).agg(F.count("*").alias("customers"))


@query("age_group", sql("""
    SELECT customer_id, CASE senior_citizen WHEN 1 THEN 'Senior' ELSE 'Under 65' END AS age_group FROM feat""",
                        "feat"))
def _(w):
    return star.dim_customer(w.features()).select(
        "customer_id", X.age_group(F.col("senior_citizen")).alias("age_group"))


@query("household", sql("""
    SELECT customer_id, CASE partner * 2 + dependents WHEN 3 THEN 'Partner + dependents'
        WHEN 2 THEN 'Partner' WHEN 1 THEN 'Dependents' ELSE 'Single' END AS household FROM feat""", "feat"))
def _(w):
    return star.dim_customer(w.features()).select(
        "customer_id", X.household(F.col("partner"), F.col("dependents")).alias("household"))


@query("payment_short", sql("""
    SELECT DISTINCT payment_method, split_part(payment_method, ' (', 1) AS payment_short FROM feat""", "feat"))
def _(w):
    return w.dim("dim_payment").select(
        "payment_method", X.payment_short(F.col("payment_method")).alias("payment_short"))


@query("service_label", sql("""
    SELECT service_name, CASE service_name WHEN 'online_security' THEN 'Online Security'
        WHEN 'online_backup' THEN 'Online Backup' WHEN 'device_protection' THEN 'Device Protection'
        WHEN 'tech_support' THEN 'Tech Support' WHEN 'streaming_tv' THEN 'Streaming Tv'
        ELSE 'Streaming Movies' END AS service, count(*) AS n_rows FROM bridge GROUP BY 1""", "bridge"))
def _(w):
    bridge = star.unpivot_addons(w.features())
    return bridge.groupBy("service_name", X.service_label(F.col("service_name")).alias("service")) \
        .agg(F.count("*").alias("n_rows"))


@query("tier_order", sql("""
    SELECT model_name, risk_tier, CAST(CASE risk_tier WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2
        WHEN 'High' THEN 3 WHEN 'Critical' THEN 4 ELSE 0 END AS INTEGER) AS tier_order, count(*) AS n
    FROM scored GROUP BY model_name, risk_tier""", "scored"))
def _(w):
    return w.scored().groupBy("model_name", "risk_tier", X.tier_order(F.col("risk_tier")).alias("tier_order")) \
        .agg(F.count("*").alias("n"))


@query("probability_bucket", sql("""
    SELECT model_name, floor(p * 10) / 10 AS probability_bucket, count(*) AS customers
    FROM scored GROUP BY 1, 2""", "scored"))
def _(w):
    return w.scored().groupBy(
        "model_name", X.probability_bucket(F.col("churn_probability")).alias("probability_bucket")) \
        .agg(F.count("*").alias("customers"))


# ---------------------------------------------------------------- star schema
for _table, _key, _label, _col, _more in [
        ("dim_contract", "contract_key", "contract_type", "contract",
         "CASE contract WHEN 'Month-to-month' THEN 1 WHEN 'One year' THEN 12 ELSE 24 END AS contract_months"),
        ("dim_payment", "payment_key", "payment_method", "payment_method",
         "CASE WHEN contains(payment_method, 'automatic') THEN 1 ELSE 0 END AS auto_pay"),
        ("dim_internet", "internet_key", "internet_service", "internet_service", "")]:
    query(_table, sql(
        f"SELECT CAST(row_number() OVER (ORDER BY {_col}) AS INTEGER) AS {_key}, {_col} AS {_label}"
        f"{', ' + _more if _more else ''} FROM (SELECT DISTINCT {_col} FROM feat)", "feat"))(
        lambda w, t=_table: w.dim(t))


@query("build_dimension", sql("""
    SELECT CAST(row_number() OVER (ORDER BY gender) AS INTEGER) AS gender_key, gender
    FROM (SELECT DISTINCT gender FROM feat)""", "feat"))
def _(w):
    return star.build_dimension(w.features(), "gender", "gender_key", "gender")


@query("dim_tenure_band", sql("""
    SELECT * FROM (VALUES ('0-6m', 1), ('7-12m', 2), ('13-24m', 3), ('25-48m', 4), ('49-60m', 5), ('61m+', 6))
        AS t(tenure_band, band_order)
    LEFT JOIN (SELECT tenure_band, count(*) AS customers FROM feat GROUP BY tenure_band) USING (tenure_band)""", "feat"))
def _(w):
    """All six bands, with the customers in each; a band without any stays."""
    sizes = w.features().groupBy("tenure_band").agg(F.count("*").alias("customers"))
    return star.dim_tenure_band(w.spark).join(sizes, "tenure_band", "left")


@query("dim_customer", sql(
    "SELECT customer_id, gender, senior_citizen, partner, dependents, family FROM feat", "feat"))
def _(w):
    return star.dim_customer(w.features())


_keys = {
    "contract_key": "CAST(dense_rank() OVER (ORDER BY contract) AS INTEGER) AS contract_key",
    "payment_key": "CAST(dense_rank() OVER (ORDER BY payment_method) AS INTEGER) AS payment_key",
    "internet_key": "CAST(dense_rank() OVER (ORDER BY internet_service) AS INTEGER) AS internet_key",
}


@query("fact_subscription", sql(f"""
    SELECT customer_id, {', '.join(_keys.values())}, tenure, tenure_band, phone_service, multiple_lines,
           paperless_billing, n_addons, n_services, {dbl('monthly_charges')} AS monthly_charges,
           {dbl('total_charges')} AS total_charges, {r('charge_drift', 6)} AS charge_drift, churn
    FROM feat""", "feat"))
def _(w):
    return doubles(w.fact(), "monthly_charges", "total_charges") \
        .withColumn("charge_drift", half_up("charge_drift", 6))


@query("unpivot_addons", sql("SELECT customer_id, service_name, status FROM bridge", "bridge"))
def _(w):
    return star.unpivot_addons(w.features())


@query("pivot_addons", sql(f"SELECT customer_id, {', '.join(D.ADDONS)} FROM feat", "feat"))
def _(w):
    return star.pivot_addons(star.unpivot_addons(w.features()))


_c360_sql = ", ".join({"monthly_charges": f"{dbl('monthly_charges')} AS monthly_charges",
                       "total_charges": f"{dbl('total_charges')} AS total_charges",
                       "charge_drift": f"{r('charge_drift', 6)} AS charge_drift"}.get(c, c) for c in C360)


def star_360(w):
    t = w.star()
    return star.customer_360(t["fact_subscription"], t["dim_customer"], t["dim_contract"],
                             t["dim_payment"], t["dim_internet"])


@query("customer_360", sql(f"SELECT {_c360_sql} FROM mart", "mart"))
def _(w):
    return doubles(star_360(w), "monthly_charges", "total_charges") \
        .withColumn("charge_drift", half_up("charge_drift", 6))


@query("feature_mart", sql(
    f"SELECT {_c360_sql}, {', '.join(D.ADDONS)}, price_vs_peers, tenure_pct_in_contract FROM mart", "mart"))
def _(w):
    mart = star.feature_mart(star_360(w), star.pivot_addons(star.unpivot_addons(w.features())),
                             w.peer_prices(), w.tenure_ranks())
    return doubles(mart, "monthly_charges", "total_charges") \
        .withColumn("charge_drift", half_up("charge_drift", 6))


@query("price_vs_peers", sql("SELECT customer_id, price_vs_peers FROM mart", "mart"))
def _(w):
    c360 = w.customer_360()
    return star.price_vs_peers(c360, w.peer_prices()).select("customer_id", "price_vs_peers")


@query("tenure_pct_in_contract", sql("SELECT customer_id, tenure_pct_in_contract FROM mart", "mart"))
def _(w):
    c360 = w.customer_360()
    return star.tenure_pct_in_contract(c360, w.tenure_ranks()) \
        .select("customer_id", "tenure_pct_in_contract")


@query("spend_quartile", sql("""
    SELECT customer_id, CAST(ntile(4) OVER (ORDER BY monthly_charges NULLS FIRST, md5('tie:' || customer_id), customer_id)
                             AS INTEGER) AS spend_quartile FROM mart""", "mart"))
def _(w):
    return ordering.ntile(w.customer_360(), "customer_id", 4, "spend_quartile", value="monthly_charges") \
        .select("customer_id", "spend_quartile")


@query("quantile_cut", sql(f"""
    SELECT m.customer_id, CASE WHEN price_vs_peers <= q[1] THEN 'cheapest' WHEN price_vs_peers <= q[2] THEN 'q2'
        WHEN price_vs_peers <= q[3] THEN 'q3' ELSE 'priciest' END AS price_quartile
    FROM mart m, (SELECT quantile_cont(price_vs_peers, [0.25, 0.5, 0.75]) AS q FROM mart)""", "mart"))
def _(w):
    return ordering.quantile_cut(w.mart(), "price_vs_peers", ["cheapest", "q2", "q3", "priciest"],
                                 "price_quartile").select("customer_id", "price_quartile")


@query("bounded_sample", sql(f"""
    SELECT customer_id, tenure, {dbl('monthly_charges')} AS monthly_charges FROM feat
    ORDER BY md5('0:' || customer_id), customer_id LIMIT 3000""", "feat"))
def _(w):
    sample = ordering.bounded_sample(w.customer_360().select("customer_id", "tenure", "monthly_charges"),
                                     3000, 0, "customer_id")
    return doubles(sample, "monthly_charges")
