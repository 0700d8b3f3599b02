"""Shared parts of the check SQL (DuckDB), written from the definitions, not from the Spark plans.

Each CTE lists what it needs; `sql(body, "mart")` puts the needed ones in front of the body.
"""

import re

from tenura.functions.domain import ADDONS

FAMILIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
RAW_ADDONS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection",
              "TechSupport", "StreamingTV", "StreamingMovies"]


def r(expr: str, digits: int) -> str:
    """Round half away from zero in plain double arithmetic."""
    scale = float(10 ** digits)
    x = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) * {scale} < 9007199254740992.0 THEN sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale} + 0.0 ELSE {x} END)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


# what Python's strip() removes, as DuckDB's trim(text, characters)
_blanks = "' ' || " + " || ".join(f"chr({c})" for c in range(0x3001) if chr(c).isspace() and c != 32)


def strip(expr: str) -> str:
    return f"trim({expr}, {_blanks})"


_item_counts = ", ".join(
    f"sum(CASE WHEN split_part(p_type, ' ', 1) = '{f}' THEN 1 ELSE 0 END) AS {a}"
    for f, a in zip(FAMILIES, ADDONS))
_raw_addons = ", ".join(
    f"""CASE WHEN internet = 'No' THEN 'No internet service'
         WHEN coalesce({a}, 0) >= 8 THEN 'Yes' ELSE 'No' END AS "{raw}" """
    for raw, a in zip(RAW_ADDONS, ADDONS))
_snake_addons = ", ".join(f'{strip(chr(34) + raw + chr(34))} AS {a}' for raw, a in zip(RAW_ADDONS, ADDONS))
_addon_yes = {a: f"(CASE WHEN {a} = 'Yes' THEN 1 ELSE 0 END)" for a in ADDONS}

CTES: dict[str, tuple[list[str], str]] = {
    "numbered": ([], """
        SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
               count(*) OVER (PARTITION BY o_custkey) AS n
        FROM orders"""),
    "snap": ([], "SELECT max(CAST(o_orderdate AS DATE)) AS snap_day FROM orders"),
    "history": (["numbered"], """
        SELECT o_custkey,
               max(CASE WHEN rn = 1 + o_custkey % least(n, 10) THEN day END) AS start_day,
               max(CASE WHEN rn = n THEN day END) AS last_day,
               max(CASE WHEN rn = n THEN o_orderstatus END) AS st,
               max(CASE WHEN rn = n THEN o_orderpriority END) AS pr
        FROM numbered GROUP BY o_custkey"""),
    "items": ([], f"""
        SELECT o_custkey, {_item_counts}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY o_custkey"""),
    "base": (["history", "snap", "items"], """
        SELECT c.*, h.*, i.* EXCLUDE (o_custkey),
               date_diff('day', h.last_day, snap_day) > 365 AS gone,
               date_diff('day', h.start_day,
                         CASE WHEN date_diff('day', h.last_day, snap_day) > 365 THEN h.last_day
                              ELSE snap_day END) // 30 AS months,
               1800 + (c_custkey * 37) % 10000 AS cents,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'DSL'
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Fiber optic'
                    ELSE 'No' END AS internet
        FROM customer c JOIN history h ON h.o_custkey = c.c_custkey CROSS JOIN snap
        LEFT JOIN items i ON i.o_custkey = c.c_custkey"""),
    "raw": (["base"], f"""
        SELECT CAST(c_custkey AS VARCHAR) AS "customerID",
               CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS "gender",
               CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS "SeniorCitizen",
               CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Partner",
               CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS "Dependents",
               CAST(months AS VARCHAR) AS "tenure",
               CASE WHEN c_custkey % 10 <> 0 THEN 'Yes' ELSE 'No' END AS "PhoneService",
               CASE WHEN c_custkey % 10 = 0 THEN 'No phone service'
                    WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
               internet AS "InternetService", {_raw_addons},
               CASE st WHEN 'P' THEN 'Month-to-month' WHEN 'O' THEN 'One year'
                       WHEN 'F' THEN 'Two year' END AS "Contract",
               CASE WHEN c_custkey % 7 < 4 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
               CASE left(pr, 1) WHEN '1' THEN 'Electronic check' WHEN '2' THEN 'Mailed check'
                    WHEN '3' THEN 'Bank transfer (automatic)'
                    ELSE 'Credit card (automatic)' END AS "PaymentMethod",
               CAST(CAST(cents AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) :: VARCHAR AS "MonthlyCharges",
               CASE WHEN months = 0 THEN ' ' ELSE
                    (CAST((cents * months * (90 + c_custkey % 21)) // 100 AS DECIMAL(18,2)) / 100)
                    :: DECIMAL(18,2) :: VARCHAR END AS "TotalCharges",
               CASE WHEN gone THEN 'Yes' ELSE 'No' END AS "Churn"
        FROM base"""),
    "cleaned": (["raw"], f"""
        SELECT {strip('"customerID"')} AS customer_id, {strip('"gender"')} AS gender,
               CAST("SeniorCitizen" AS INTEGER) AS senior_citizen,
               CASE WHEN {strip('"Partner"')} = 'Yes' THEN 1 ELSE 0 END AS partner,
               CASE WHEN {strip('"Dependents"')} = 'Yes' THEN 1 ELSE 0 END AS dependents,
               CAST({strip('"tenure"')} AS INTEGER) AS tenure,
               CASE WHEN {strip('"PhoneService"')} = 'Yes' THEN 1 ELSE 0 END AS phone_service,
               {strip('"MultipleLines"')} AS multiple_lines,
               {strip('"InternetService"')} AS internet_service, {_snake_addons},
               {strip('"Contract"')} AS contract,
               CASE WHEN {strip('"PaperlessBilling"')} = 'Yes' THEN 1 ELSE 0 END AS paperless_billing,
               {strip('"PaymentMethod"')} AS payment_method,
               CAST({strip('"MonthlyCharges"')} AS DECIMAL(18,2)) AS monthly_charges,
               CASE WHEN TRY_CAST({strip('"TotalCharges"')} AS DECIMAL(18,2)) IS NULL
                         AND CAST({strip('"tenure"')} AS INTEGER) = 0 THEN CAST(0 AS DECIMAL(18,2))
                    ELSE TRY_CAST({strip('"TotalCharges"')} AS DECIMAL(18,2)) END AS total_charges,
               CASE WHEN {strip('"Churn"')} = 'Yes' THEN 1 ELSE 0 END AS churn
        FROM raw"""),
    "feat0": (["cleaned"], f"""
        SELECT *,
               CASE WHEN internet_service IS DISTINCT FROM 'No' THEN 1 ELSE 0 END AS has_internet,
               CASE WHEN multiple_lines = 'Yes' THEN 1 ELSE 0 END AS multiple_lines_flag,
               {' + '.join(_addon_yes.values())} AS n_addons,
               CASE WHEN {_addon_yes['online_security']} + {_addon_yes['tech_support']}
                         + {_addon_yes['device_protection']} >= 2 THEN 1 ELSE 0 END AS has_protection_bundle,
               CASE WHEN contains(payment_method, 'automatic') THEN 1 ELSE 0 END AS auto_pay,
               CASE contract WHEN 'Month-to-month' THEN 1 WHEN 'One year' THEN 12
                             WHEN 'Two year' THEN 24 END AS contract_months,
               CASE WHEN tenure BETWEEN 0 AND 6 THEN '0-6m' WHEN tenure BETWEEN 7 AND 12 THEN '7-12m'
                    WHEN tenure BETWEEN 13 AND 24 THEN '13-24m' WHEN tenure BETWEEN 25 AND 48 THEN '25-48m'
                    WHEN tenure BETWEEN 49 AND 60 THEN '49-60m' WHEN tenure >= 61 THEN '61m+' END AS tenure_band,
               CASE WHEN tenure > 0 THEN CAST(total_charges AS DOUBLE) / CAST(tenure AS DOUBLE)
                    ELSE CAST(monthly_charges AS DOUBLE) END AS avg_historic_charge,
               CASE WHEN tenure <= 6 THEN 1 ELSE 0 END AS is_new_customer,
               CASE WHEN partner = 1 OR dependents = 1 THEN 1 ELSE 0 END AS family,
               CASE WHEN internet_service = 'Fiber optic' AND tech_support IS DISTINCT FROM 'Yes'
                    THEN 1 ELSE 0 END AS fiber_no_support
        FROM cleaned"""),
    "feat": (["feat0"], """
        SELECT *, phone_service + multiple_lines_flag + has_internet + n_addons AS n_services,
               CAST(monthly_charges AS DOUBLE) - avg_historic_charge AS charge_drift,
               CAST(monthly_charges AS DOUBLE)
                 / CAST(greatest(phone_service + multiple_lines_flag + has_internet + n_addons, 1) AS DOUBLE)
                 AS charge_per_service
        FROM feat0"""),
    "mart": (["feat"], f"""
        SELECT *, contract AS contract_type,
               {r('''CAST(monthly_charges AS DOUBLE)
                   - CAST(sum(monthly_charges) OVER peer AS DOUBLE) / count(*) OVER peer''', 4)} AS price_vs_peers,
               {r('percent_rank() OVER (PARTITION BY contract ORDER BY tenure)', 4)} AS tenure_pct_in_contract
        FROM feat WINDOW peer AS (PARTITION BY internet_service, contract)"""),
    "bridge": (["feat"], f"""
        UNPIVOT (SELECT customer_id, {', '.join(ADDONS)} FROM feat)
        ON {', '.join(ADDONS)} INTO NAME service_name VALUE status"""),
    "quota0": (["feat"], """
        SELECT churn, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM feat GROUP BY churn"""),
    "quota1": (["quota0"], """
        SELECT *, want * n / total AS exact FROM (
            SELECT *, CAST(ceil(total * 0.2 - 1e-9) AS BIGINT) AS want FROM quota0)"""),
    "quota2": (["quota1"], """
        SELECT churn, n, CAST(floor(exact) + CASE
                   WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, churn) <= spare
                   THEN 1 ELSE 0 END AS BIGINT) AS test_rows
        FROM (SELECT *, want - sum(floor(exact)) OVER () AS spare FROM quota1)"""),
    "quota3": (["quota2"], """
        SELECT *, CAST(sum(n - test_rows) OVER () AS BIGINT) AS total FROM quota2"""),
    "quota4": (["quota3"], """
        SELECT *, want * (n - test_rows) / total AS exact FROM (
            SELECT *, CAST(ceil(total * 0.1875 - 1e-9) AS BIGINT) AS want FROM quota3)"""),
    "quota": (["quota4"], """
        SELECT churn, n, test_rows, CAST(floor(exact) + CASE
                   WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, churn) <= spare
                   THEN 1 ELSE 0 END AS BIGINT) AS valid_rows
        FROM (SELECT *, want - sum(floor(exact)) OVER () AS spare FROM quota4)"""),
    "splits": (["mart", "quota"], """
        SELECT customer_id, CASE WHEN rn <= test_rows THEN 'test'
                                 WHEN rn <= test_rows + valid_rows THEN 'valid' ELSE 'train' END AS split
        FROM (SELECT customer_id, churn, row_number() OVER (
                  PARTITION BY churn ORDER BY md5('42:' || customer_id), customer_id) AS rn FROM mart) x
        JOIN quota USING (churn)"""),
    "points": (["mart"], """
        SELECT *, 60 - least(tenure, 60) AS tpoints,
               CASE contract WHEN 'Month-to-month' THEN 30 WHEN 'One year' THEN 10 ELSE 0 END
               + (60 - least(tenure, 60))
               + CASE WHEN internet_service = 'Fiber optic' THEN 10 ELSE 0 END
               + CASE WHEN payment_method = 'Electronic check' THEN 15 ELSE 0 END
               + CAST(customer_id AS BIGINT) % 25 AS points
        FROM mart"""),
    "scored0": (["points"], f"""
        SELECT customer_id, 'scorecard' AS model_name, {r('points / 140.0e0', 5)} AS p FROM points
        UNION ALL
        SELECT customer_id, 'scorecard_tenure', {r('tpoints / 60.0e0', 5)} FROM points"""),
    "scored": (["scored0", "splits"], """
        SELECT s.*, CASE WHEN p < 0.2 THEN 'Low' WHEN p < 0.4 THEN 'Medium' WHEN p < 0.6 THEN 'High'
                         ELSE 'Critical' END AS risk_tier,
               m.churn AS y, CAST(m.monthly_charges AS DOUBLE) AS charge, m.monthly_charges,
               m.tenure, sp.split
        FROM scored0 s JOIN mart m USING (customer_id) JOIN splits sp USING (customer_id)"""),
    "best": (["scored"], """
        SELECT *, CASE WHEN p >= 0.4 THEN 1 ELSE 0 END AS targeted FROM scored
        WHERE model_name = 'scorecard'"""),
    "seg": (["mart"], """
        SELECT *, CASE WHEN has_internet = 0 THEN 1
                       WHEN contract_months = 1 THEN CASE WHEN auto_pay = 1 THEN 0 ELSE 3 END
                       ELSE 2 END AS segment_id FROM mart"""),
    "spans": ([], """
        SELECT user_id,
               date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS duration,
               CASE WHEN date_diff('day', CAST(max(ts) AS DATE),
                        (SELECT CAST(max(ts) AS DATE) FROM events)) > 0 THEN 1 ELSE 0 END AS stopped
        FROM events GROUP BY user_id"""),
}


def sql(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """WITH <needed CTEs in order> body. `extra` CTEs come after the shared ones."""
    order: list[str] = []

    def visit(name):
        for dep in CTES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in order]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    text = (f"WITH {', '.join(parts)} " if parts else "") + body
    return re.sub(r"\s+", " ", text).strip()


C360 = ["customer_id", "gender", "senior_citizen", "partner", "dependents", "family", "contract_type",
        "contract_months", "payment_method", "auto_pay", "internet_service", "tenure", "tenure_band",
        "phone_service", "multiple_lines", "paperless_billing", "n_addons", "n_services",
        "monthly_charges", "total_charges", "charge_drift", "churn"]
