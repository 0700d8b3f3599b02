"""Contract and integrity queries, over the extract as it is and over one with planted faults."""

from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.operators import contract, star
from tenura.plans.catalog import query
from tenura.plans.check_sql import sql, strip

# The planted faults: every rule finds something, on every data set.
FAULTY = {
    "faulty": """
        SELECT CASE WHEN CAST("customerID" AS BIGINT) % 50 = 7 THEN '7' ELSE "customerID" END AS "customerID",
               * EXCLUDE ("customerID", "Contract", "PaymentMethod", "tenure", "MonthlyCharges", "TotalCharges"),
               CASE WHEN CAST("customerID" AS BIGINT) % 20 = 3 THEN 'Three year' ELSE "Contract" END AS "Contract",
               CASE WHEN CAST("customerID" AS BIGINT) % 30 = 4 THEN chr(9) || 'Mailed check ' || chr(10) ELSE "PaymentMethod" END
                   AS "PaymentMethod",
               CASE WHEN CAST("customerID" AS BIGINT) % 40 = 5 THEN 'n/a' ELSE "tenure" END AS "tenure",
               CASE WHEN CAST("customerID" AS BIGINT) % 25 = 6 THEN '-' || "MonthlyCharges"
                    ELSE "MonthlyCharges" END AS "MonthlyCharges",
               CASE WHEN CAST("customerID" AS BIGINT) % 35 = 8 THEN ' ' ELSE "TotalCharges" END AS "TotalCharges"
        FROM raw"""}


def faulty(raw):
    key = F.col("customerID").cast("bigint")

    def swap(column, every, at, value):
        return F.when(key % every == at, value).otherwise(F.col(column)).alias(column)

    changed = {
        "customerID": swap("customerID", 50, 7, F.lit("7")),
        "Contract": swap("Contract", 20, 3, F.lit("Three year")),
        "PaymentMethod": swap("PaymentMethod", 30, 4, F.lit("\tMailed check \n")),
        "tenure": swap("tenure", 40, 5, F.lit("n/a")),
        "MonthlyCharges": swap("MonthlyCharges", 25, 6, F.concat(F.lit("-"), "MonthlyCharges")),
        "TotalCharges": swap("TotalCharges", 35, 8, F.lit(" ")),
    }
    return raw.select([changed.get(c, F.col(c)) for c in raw.columns])


_allowed = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {strip(chr(34) + c + chr(34))} AS value, [" + ", ".join(f"'{v}'" for v in values)
    + "] AS allowed FROM {t}" for c, values in D.RAW_DOMAINS.items())
_domain_sql = ("SELECT column_name, value, count(*) AS n FROM (" + _allowed
               + ") WHERE NOT list_contains(allowed, value) GROUP BY 1, 2")
_num = f'TRY_CAST({strip(chr(34) + "{c}" + chr(34))} AS DOUBLE)'
_parse_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({_num.format(c=c)} IS NULL) AS non_numeric, "
    f"count(*) FILTER ({_num.format(c=c)} < 0) AS negative FROM faulty" for c in D.RAW_NUMBERS)
_blank_sql = f"""
    SELECT count(*) FILTER (bad AND zero) AS excused, count(*) FILTER (bad AND NOT zero) AS not_excused
    FROM (SELECT {_num.format(c='TotalCharges')} IS NULL AS bad,
                 coalesce({_num.format(c='tenure')} = 0, false) AS zero FROM {{t}})"""
_rate_sql = """
    SELECT rate, NOT (rate > 0.05 AND rate < 0.6) AS off
    FROM (SELECT CAST(count(*) FILTER ("Churn" = 'Yes') AS DOUBLE) / count(*) AS rate FROM raw)"""


@query("check_required_columns", sql("""
    SELECT 'Contract' AS missing, count(*) AS n_rows FROM raw
    UNION ALL SELECT 'gender', count(*) FROM raw""", "raw"))
def _(w):
    """Names of the columns a narrowed extract lacks, beside its row count."""
    narrowed = w.raw().drop("Contract", "gender")
    missing = contract.check_required_columns(narrowed)
    return narrowed.agg(F.count("*").alias("n_rows")).select(
        F.explode(F.array(*[F.lit(c) for c in missing])).alias("missing"), "n_rows")


@query("check_unique_key", sql(
    'SELECT count(*) - count(DISTINCT "customerID") AS repeats FROM faulty', "raw", extra=FAULTY))
def _(w):
    return contract.check_unique_key(faulty(w.raw()), D.RAW_KEY)


@query("check_domains", sql(_domain_sql.format(t="faulty"), "raw", extra=FAULTY))
def _(w):
    return contract.check_domains(faulty(w.raw()))


@query("check_numeric_parse", sql(_parse_sql, "raw", extra=FAULTY))
def _(w):
    return contract.check_numeric_parse(faulty(w.raw()))


@query("check_non_negative", sql(
    f"SELECT column_name, negative FROM ({_parse_sql})", "raw", extra=FAULTY))
def _(w):
    return contract.check_non_negative(faulty(w.raw()))


@query("check_conditional_blank", sql(_blank_sql.format(t="faulty"), "raw", extra=FAULTY))
def _(w):
    return contract.check_conditional_blank(faulty(w.raw()))


@query("check_rate_drift", sql(_rate_sql, "raw"))
def _(w):
    return contract.check_rate_drift(w.raw())


def _report_sql(t):
    return f"""
    SELECT * FROM (
        SELECT 'unique_key' AS check_name, 'customerID' AS column_name, 'error' AS severity,
               count(*) - count(DISTINCT "customerID") AS n FROM {t}
        UNION ALL SELECT 'domain', column_name, 'error', count(*) FROM ({_domain_sql.format(t=t)}) GROUP BY column_name
        UNION ALL SELECT 'numeric', column_name, 'error', non_numeric FROM ({_parse_sql.replace('faulty', t)})
                  WHERE column_name <> 'TotalCharges'
        UNION ALL SELECT 'negative', column_name, 'error', negative FROM ({_parse_sql.replace('faulty', t)})
        UNION ALL SELECT 'numeric', 'TotalCharges', 'error', excused + not_excused
                  FROM ({_blank_sql.format(t=t)}) WHERE not_excused > 0
        UNION ALL SELECT 'blank_total', 'TotalCharges', 'warning', excused
                  FROM ({_blank_sql.format(t=t)}) WHERE not_excused = 0
        UNION ALL SELECT 'churn_rate', 'Churn', 'warning', 1 FROM ({_rate_sql.replace('FROM raw', 'FROM ' + t)}) WHERE off
    ) WHERE n > 0"""


@query("validation_report", sql(_report_sql("raw"), "raw"))
def _(w):
    return contract.validation_report(w.raw())


@query("validation_report_faulty", sql(_report_sql("faulty"), "raw", extra=FAULTY))
def _(w):
    return contract.validation_report(faulty(w.raw()))


# ---------------------------------------------------------------- warehouse rules
@query("check_primary_key", sql("""
    SELECT contract_type, tenure, count(*) AS n FROM mart GROUP BY contract_type, tenure HAVING count(*) > 1""",
                                "mart"))
def _(w):
    """The rule on a key that is not unique, so that it has something to report."""
    return contract.check_primary_key(w.customer_360(), ["contract_type", "tenure"])


@query("check_not_null", sql("""
    SELECT 'total_charges' AS column_name, count(*) FILTER (total_charges IS NULL) AS nulls FROM feat_faulty
    UNION ALL SELECT 'monthly_charges', count(*) FILTER (monthly_charges IS NULL) FROM feat_faulty
    UNION ALL SELECT 'tenure_band', count(*) FILTER (tenure_band IS NULL) FROM feat_faulty""", "feat",
    extra={"feat_faulty": """SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 35 = 8 THEN NULL
                                               ELSE total_charges END AS total_charges) FROM feat"""}))
def _(w):
    holes = w.customer_360().withColumn("total_charges", F.when(
        F.col("customer_id").cast("bigint") % 35 != 8, F.col("total_charges")))
    return contract.check_not_null(holes, ["total_charges", "monthly_charges", "tenure_band"])


@query("check_value_in", sql("SELECT count(*) FILTER (n_addons NOT IN (0, 1)) AS outside FROM feat", "feat"))
def _(w):
    return contract.check_value_in(w.fact(), "n_addons", [0, 1])


@query("check_foreign_key", sql("""
    SELECT customer_id, tenure FROM feat WHERE payment_method IN ('Electronic check')""", "feat"))
def _(w):
    """Fact rows without a parent once one payment method is taken out of its dimension."""
    payments = w.dim("dim_payment").where(F.col("payment_method") != "Electronic check")
    return contract.check_foreign_key(w.fact(), "payment_key", payments, "payment_key") \
        .select("customer_id", "tenure")


@query("reconcile_row_counts", sql("""
    SELECT unnest(['extract', 'fact_subscription', 'feature_mart']) AS table_name, count(*) AS n,
           true AS matches FROM feat""", "feat"))
def _(w):
    """The load is stopped by `reconcile` if a table differs; the mart counted is the joined view."""
    tables = {"extract": w.raw(), "fact_subscription": w.fact(), "feature_mart": w.mart_view()}
    contract.reconcile(tables)
    return contract.reconcile_row_counts(tables)


@query("reconcile_row_counts_faulty", sql("""
    SELECT 'extract' AS table_name, count(*) AS n, true AS matches FROM feat
    UNION ALL SELECT 'fact_subscription', count(*), false FROM feat WHERE CAST(customer_id AS BIGINT) % 9 <> 4
    UNION ALL SELECT 'feature_mart', 2 * count(*), false FROM feat""", "feat"))
def _(w):
    """Lost rows in one table and repeated ones in another."""
    return contract.reconcile_row_counts({
        "extract": w.raw(), "fact_subscription": w.fact().where(F.col("customer_id").cast("bigint") % 9 != 4),
        "feature_mart": w.mart().unionByName(w.mart())})


_rel = [("fact_subscription.contract_key -> dim_contract.contract_key", False),
        ("fact_subscription.payment_key -> dim_payment.payment_key", False),
        ("fact_subscription.internet_key -> dim_internet.internet_key", False),
        ("fact_subscription.tenure_band -> dim_tenure_band.tenure_band", False),
        ("fact_subscription.customer_id -> dim_customer.customer_id", True),
        ("fact_subscription.customer_id -> fact_churn_score.customer_id", True),
        ("bridge_customer_service.customer_id -> fact_subscription.customer_id", False)]


_rel.insert(5, ("fact_subscription.customer_id -> dim_segment.customer_id", True))


def _related(w):
    """All tables that take part in a relationship."""
    segments = w.segments().select("customer_id", "segment_id")
    return {**w.star(), "fact_churn_score": w.best_scores(), "dim_segment": segments}


@query("check_relationship", sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS relationship, unnest(['parent_not_unique', 'orphans'"
        f"{', ' + repr('child_not_unique') if one else ''}]) AS problem, "
        f"(SELECT count(*) - count(DISTINCT customer_id) FROM feat) AS n" for name, one in _rel) + ")", "feat"))
def _(w):
    return contract.check_relationship(_related(w))


_id = "CAST(customer_id AS BIGINT)"


@query("check_relationship_faulty", sql(f"""
    SELECT relationship, problem, CASE
        WHEN problem = 'orphans' AND relationship LIKE '%dim_payment%' THEN (SELECT count(*) FROM feat WHERE payment_method = 'Mailed check')
        WHEN problem = 'orphans' AND relationship LIKE '%dim_segment%' THEN (SELECT count(*) FROM feat WHERE {_id} % 9 = 4)
        WHEN problem = 'orphans' AND relationship LIKE 'bridge%' THEN (SELECT 6 * count(*) FROM feat WHERE {_id} % 7 = 2)
        WHEN problem = 'parent_not_unique' AND relationship LIKE '%dim_customer%' THEN (SELECT count(*) FROM feat WHERE {_id} % 11 = 3)
        ELSE 0 END AS n
    FROM (""" + " UNION ALL ".join(
        f"SELECT '{name}' AS relationship, unnest(['parent_not_unique', 'orphans'"
        f"{', ' + repr('child_not_unique') if one else ''}]) AS problem" for name, one in _rel) + """)
""", "feat"))
def _(w):
    """Planted: a payment method without its row, segments and facts that are missing, customers there twice."""
    key = F.col("customer_id").cast("bigint")
    t = _related(w)
    t["dim_payment"] = t["dim_payment"].where(F.col("payment_method") != "Mailed check")
    t["dim_segment"] = t["dim_segment"].where(key % 9 != 4)
    t["dim_customer"] = t["dim_customer"].unionByName(t["dim_customer"].where(key % 11 == 3))
    # the fact stays whole for the other relationships: the bridge has customers of its own instead
    lost = t["bridge_customer_service"].where(key % 7 == 2).withColumn("customer_id", F.concat(F.lit("x"), "customer_id"))
    t["bridge_customer_service"] = t["bridge_customer_service"].where(key % 7 != 2).unionByName(lost)
    return contract.check_relationship(t)


@query("check_bridge_cardinality", sql("""
    SELECT customer_id, count(*) AS n FROM bridge
    WHERE NOT (service_name = 'tech_support' AND status = 'Yes') GROUP BY customer_id HAVING count(*) <> 6""",
                                       "bridge"))
def _(w):
    bridge = star.unpivot_addons(w.features())
    thinned = bridge.where(~((F.col("service_name") == "tech_support") & (F.col("status") == "Yes")))
    return contract.check_bridge_cardinality(thinned)


_rules = [(t, rule) for t, spec in D.TABLE_RULES.items() for rule in
          [f"unique {', '.join(k)}" for k in spec["unique"]] + [f"not null {c}" for c in spec["required"]]
          + [f"0/1 {c}" for c in spec.get("binary", [])]]


@query("check_table_rules_faulty", sql(
    "SELECT table_name, rule, CASE WHEN table_name = 'fact_subscription' AND rule = 'unique customer_id' "
    f"THEN (SELECT count(*) FROM feat WHERE {_id} % 11 = 3) "
    f"WHEN table_name = 'fact_subscription' AND rule = 'not null tenure' THEN (SELECT count(*) FROM feat WHERE {_id} % 11 = 3) "
    f"WHEN table_name = 'dim_customer' AND rule = 'not null gender' THEN (SELECT count(*) FROM feat WHERE {_id} % 13 = 1) "
    f"WHEN table_name = 'fact_subscription' AND rule = '0/1 churn' THEN (SELECT count(*) FROM feat WHERE {_id} % 11 = 3) "
    "ELSE 0 END AS n FROM (VALUES "
    + ", ".join(f"('{t}', '{rule}')" for t, rule in _rules) + ") AS v(table_name, rule)", "feat"))
def _(w):
    """Planted: facts there twice, the second time without tenure and with a wrong flag; customers without gender."""
    key = F.col("customer_id").cast("bigint")
    t = {**w.star(), "model_scores": w.model_scores()}
    again = t["fact_subscription"].where(key % 11 == 3).withColumns({"tenure": F.lit(None).cast("int"), "churn": F.lit(2)})
    t["fact_subscription"] = t["fact_subscription"].unionByName(again)
    t["dim_customer"] = t["dim_customer"].withColumn("gender", F.when(key % 13 != 1, F.col("gender")))
    return contract.check_table_rules(t)


@query("check_table_rules", sql(
    "SELECT table_name, rule, (SELECT count(*) - count(customer_id) FROM feat) AS n FROM (VALUES "
    + ", ".join(f"('{t}', '{rule}')" for t, rule in _rules) + ") AS v(table_name, rule)", "feat"))
def _(w):
    return contract.check_table_rules({**w.star(), "model_scores": w.model_scores()})
