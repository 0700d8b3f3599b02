"""Star schema: dimensions, fact, bridge, the denormalised views built from them."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.functions.numeric import half_up, ratio
from tenura.operators.ordering import join_same, ordinals


def build_dimension(df: DataFrame, value: str, key: str, name: str) -> DataFrame:
    """Distinct labels in alphabetical order with keys 1..n, however many labels there are."""
    labels = df.select(F.col(value).alias(name)).where(F.col(value).isNotNull()).distinct()
    return ordinals(labels, name, key).select(key, name)


def dim_contract(features: DataFrame) -> DataFrame:
    dim = build_dimension(features, "contract", "contract_key", "contract_type")
    return dim.withColumn("contract_months", X.contract_months(F.col("contract_type")))


def dim_payment(features: DataFrame) -> DataFrame:
    dim = build_dimension(features, "payment_method", "payment_key", "payment_method")
    return dim.withColumn("auto_pay", X.auto_pay(F.col("payment_method")))


def dim_internet(features: DataFrame) -> DataFrame:
    return build_dimension(features, "internet_service", "internet_key", "internet_service")


def dim_customer(features: DataFrame) -> DataFrame:
    return features.select("customer_id", "gender", "senior_citizen", "partner", "dependents", "family")


def dim_tenure_band(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(label, i) for i, (label, _) in enumerate(D.TENURE_BANDS, 1)],
        "tenure_band string, band_order int")


def fact_subscription(features: DataFrame, contracts: DataFrame, payments: DataFrame,
                      internets: DataFrame) -> DataFrame:
    """Features with labels replaced by keys, null for a missing label: no customer is lost. The
    dimensions come from written tables, so Catalyst sees their size and broadcasts them by itself."""
    return (
        features
        .join(contracts.select("contract_key", F.col("contract_type").alias("contract")), "contract", "left")
        .join(payments.select("payment_key", "payment_method"), "payment_method", "left")
        .join(internets, "internet_service", "left")
        .select("customer_id", "contract_key", "payment_key", "internet_key", "tenure",
                "tenure_band", "phone_service", "multiple_lines", "paperless_billing", "n_addons",
                "n_services", "monthly_charges", "total_charges", "charge_drift", "churn")
    )


def unpivot_addons(features: DataFrame) -> DataFrame:
    """Wide to long: one row per customer and add-on."""
    return features.unpivot("customer_id", D.ADDONS, "service_name", "status")


def pivot_addons(bridge: DataFrame) -> DataFrame:
    """Long to wide. The pivot values are given, so no extra job looks for them."""
    return bridge.groupBy("customer_id").pivot("service_name", D.ADDONS).agg(F.max("status"))


def customer_360(fact: DataFrame, customers: DataFrame, contracts: DataFrame,
                 payments: DataFrame, internets: DataFrame) -> DataFrame:
    """One wide row per customer: small dimensions first (broadcast), then the 1:1 customer join."""
    return (
        fact.join(contracts, "contract_key", "left").join(payments, "payment_key", "left")
        .join(internets, "internet_key", "left").join(customers, "customer_id")
        .select("customer_id", "gender", "senior_citizen", "partner", "dependents", "family",
                "contract_type", "contract_months", "payment_method", "auto_pay",
                "internet_service", "tenure", "tenure_band", "phone_service", "multiple_lines",
                "paperless_billing", "n_addons", "n_services", "monthly_charges",
                "total_charges", "charge_drift", "churn")
    )


def peer_prices(c360: DataFrame) -> DataFrame:
    """Average charge per internet product and contract: one row per label pair."""
    return c360.groupBy("internet_service", "contract_type").agg(
        ratio(F.sum("monthly_charges"), F.count("*")).alias("peer_charge"))


def tenure_ranks(c360: DataFrame) -> DataFrame:
    """Percent rank of each tenure within its contract, from counts per (contract, tenure).

    The windows run over whole months, not customers. (rank - 1) / (n - 1); 0 for a single row.
    """
    counts = c360.groupBy("contract_type", "tenure").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("contract_type")
    shorter = whole.orderBy("tenure").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "contract_type", "tenure",
        F.coalesce(ratio(F.coalesce(F.sum("n").over(shorter), F.lit(0)), F.sum("n").over(whole) - 1),
                   F.lit(0.0)).alias("pct_rank"))


def price_vs_peers(c360: DataFrame, peers: DataFrame) -> DataFrame:
    """Charge minus the average of customers on the same product and contract. Joining the small
    averages back avoids a window that would send a whole product line to one task; `peers` comes from a
    written table, so it is broadcast by its size."""
    return join_same(c360, peers, ["internet_service", "contract_type"]).withColumn(
        "price_vs_peers",
        half_up(F.col("monthly_charges").cast("double") - F.col("peer_charge"), 4)).drop("peer_charge")


def tenure_pct_in_contract(c360: DataFrame, ranks: DataFrame) -> DataFrame:
    return join_same(c360, ranks, ["contract_type", "tenure"]).withColumn(
        "tenure_pct_in_contract", half_up(F.col("pct_rank"), 4)).drop("pct_rank")


def feature_mart(c360: DataFrame, addons_wide: DataFrame, peers: DataFrame,
                 ranks: DataFrame) -> DataFrame:
    """Modelling input: the 360 view, add-ons as columns, and the two features relative to the base."""
    wide = tenure_pct_in_contract(price_vs_peers(c360, peers), ranks)
    return wide.join(addons_wide, "customer_id").select(
        *c360.columns, *D.ADDONS, "price_vs_peers", "tenure_pct_in_contract")
