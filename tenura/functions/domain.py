"""Fixed values of the subscription domain: labels, limits and rates that decide the results."""

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: allowed labels of the raw extract -------------------------------------------
YES_NO = ["Yes", "No"]
ADDON_STATUS = ["Yes", "No", "No internet service"]
RAW_DOMAINS = {
    "gender": ["Male", "Female"],
    "SeniorCitizen": ["0", "1"],
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ADDON_STATUS,
    "OnlineBackup": ADDON_STATUS,
    "DeviceProtection": ADDON_STATUS,
    "TechSupport": ADDON_STATUS,
    "StreamingTV": ADDON_STATUS,
    "StreamingMovies": ADDON_STATUS,
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": YES_NO,
    "PaymentMethod": [
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ],
    "Churn": YES_NO,
}
RAW_KEY = "customerID"
RAW_NUMBERS = ["tenure", "MonthlyCharges", "TotalCharges"]
RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]
EXPECTED_CHURN_RATE = (0.05, 0.60)

# --- fixed values: service, contract, band and tier labels -------------------------------------
ADDONS = ["online_security", "online_backup", "device_protection",
          "tech_support", "streaming_tv", "streaming_movies"]
PROTECTION_ADDONS = ["online_security", "tech_support", "device_protection"]
YES_FLAGS = ["partner", "dependents", "phone_service", "paperless_billing", "churn"]
CONTRACT_MONTHS = {"Month-to-month": 1, "One year": 12, "Two year": 24}
TENURE_BANDS = [("0-6m", 6), ("7-12m", 12), ("13-24m", 24),
                ("25-48m", 48), ("49-60m", 60), ("61m+", None)]   # label, last month included
RISK_TIERS = [("Low", 0.2), ("Medium", 0.4), ("High", 0.6), ("Critical", 1.0001)]  # label, first p outside
ALERT_BANDS = [(0.40, "#B8431D"), (0.25, "#EB6834"), (0.15, "#F5B394"), (None, "#9CC2EF")]

# --- fixed values: model inputs ----------------------------------------------------------------
MODEL_LABELS = ["gender", "contract_type", "payment_method", "internet_service", "multiple_lines",
                *ADDONS]
MODEL_NUMBERS = ["senior_citizen", "partner", "dependents", "tenure", "phone_service",
                 "paperless_billing", "auto_pay", "contract_months", "n_addons", "n_services",
                 "monthly_charges", "log_total_charges", "charge_drift", "price_vs_peers"]
SEGMENT_FEATURES = ["tenure", "monthly_charges", "n_services", "n_addons",
                    "contract_months", "auto_pay", "has_internet"]

# --- fixed values: columns looked at by the exploratory tables ---------------------------------
RATE_FEATURES = ["contract_type", "internet_service", "payment_method", "paperless_billing",
                 "senior_citizen", "family", "tech_support", "online_security"]
ASSOCIATION_FEATURES = ["contract_type", "internet_service", "payment_method", "tech_support",
                        "online_security", "paperless_billing", "senior_citizen", "gender",
                        "partner", "streaming_tv"]
RANK_FEATURES = ["tenure", "monthly_charges", "total_charges", "n_services", "charge_drift",
                 "price_vs_peers"]
CORRELATION_FEATURES = ["tenure", "monthly_charges", "total_charges", "n_services", "n_addons",
                        "charge_drift", "senior_citizen", "family", "paperless_billing",
                        "auto_pay", "contract_months", "churn"]

MONEY = T.DecimalType(18, 2)


@dataclass(frozen=True)
class Economics:
    """What one retention offer costs and brings (fixed default values)."""

    offer_cost: float = 50.0
    months_saved: int = 8
    success_rate: float = 0.30


@dataclass(frozen=True)
class SplitSizes:
    test: float = 0.20
    valid: float = 0.15
    folds: int = 5
    seed: int = 42


# Declared relationships of the star: (from table, column, to table, column, cardinality).
RELATIONSHIPS = [
    ("fact_subscription", "contract_key", "dim_contract", "contract_key", "many_to_one"),
    ("fact_subscription", "payment_key", "dim_payment", "payment_key", "many_to_one"),
    ("fact_subscription", "internet_key", "dim_internet", "internet_key", "many_to_one"),
    ("fact_subscription", "tenure_band", "dim_tenure_band", "tenure_band", "many_to_one"),
    ("fact_subscription", "customer_id", "dim_customer", "customer_id", "one_to_one"),
    ("fact_subscription", "customer_id", "dim_segment", "customer_id", "one_to_one"),
    ("fact_subscription", "customer_id", "fact_churn_score", "customer_id", "one_to_one"),
    ("bridge_customer_service", "customer_id", "fact_subscription", "customer_id", "many_to_one"),
]

# Keys, required columns and value limits of the warehouse tables.
TABLE_RULES = {
    "dim_contract": {"unique": [["contract_key"], ["contract_type"]],
                     "required": ["contract_type", "contract_months"]},
    "dim_payment": {"unique": [["payment_key"], ["payment_method"]],
                    "required": ["payment_method", "auto_pay"], "binary": ["auto_pay"]},
    "dim_internet": {"unique": [["internet_key"], ["internet_service"]],
                     "required": ["internet_service"]},
    "dim_customer": {"unique": [["customer_id"]],
                     "required": ["gender", "senior_citizen", "partner", "dependents", "family"]},
    "fact_subscription": {"unique": [["customer_id"]],
                          "required": ["contract_key", "payment_key", "internet_key", "tenure",
                                       "tenure_band", "phone_service", "multiple_lines",
                                       "paperless_billing", "n_addons", "n_services",
                                       "monthly_charges", "total_charges", "churn"],
                          "binary": ["churn"]},
    "bridge_customer_service": {"unique": [["customer_id", "service_name"]],
                                "required": ["customer_id", "service_name", "status"]},
    "model_scores": {"unique": [["customer_id", "model_name"]],
                     "required": ["customer_id", "model_name", "churn_probability", "risk_tier",
                                  "scored_at"]},
}
