"""Cleaning and feature columns: projections only, so they stay inside whole-stage codegen."""

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tenura.functions import domain as D
from tenura.functions.numeric import ratio


def snake_name(name: str) -> str:
    """customerID -> customer_id, MonthlyCharges -> monthly_charges, StreamingTV -> streaming_tv."""
    if name == "customerID":
        return "customer_id"
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


#: Everything that counts as white space, as in the reference's strip: by rule, not by list.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Without white space at both ends: tabs, line ends and the wide spaces too."""
    return F.btrim(text, F.lit(BLANKS))


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select([
        strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def cast_types(df: DataFrame) -> DataFrame:
    """Whole numbers and money; a value that does not parse stops the job, as in a strict load."""
    return df.withColumns({
        "senior_citizen": F.col("senior_citizen").cast("int"),
        "tenure": F.col("tenure").cast("int"),
        "monthly_charges": F.col("monthly_charges").cast(D.MONEY),
    })


def impute_total_charges(df: DataFrame) -> DataFrame:
    """A blank total is 0 for a customer not billed yet (tenure 0); any other blank stays null."""
    amount = F.col("total_charges").try_cast(D.MONEY)
    return df.withColumn(
        "total_charges",
        F.when(amount.isNull() & (F.col("tenure") == 0), F.lit(0).cast(D.MONEY)).otherwise(amount))


def binarise(df: DataFrame, columns=tuple(D.YES_FLAGS)) -> DataFrame:
    return df.withColumns({c: F.coalesce((F.col(c) == "Yes").cast("int"), F.lit(0)) for c in columns})


def clean(raw: DataFrame) -> DataFrame:
    return binarise(impute_total_charges(cast_types(trim_strings(snake_case_columns(raw)))))


def flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def contract_months(contract: Column) -> Column:
    months = F.lit(None).cast("int")
    for label, n in D.CONTRACT_MONTHS.items():
        months = F.when(contract == label, F.lit(n)).otherwise(months)
    return months


def auto_pay(method: Column) -> Column:
    return flag(method.contains("automatic"))


def tenure_band(tenure: Column) -> Column:
    """Right-closed bands: the named last month belongs to the band."""
    band = F.when(tenure < 0, F.lit(None).cast("string"))
    for label, last in D.TENURE_BANDS:
        band = band.when(tenure <= last, F.lit(label)) if last is not None else \
            band.when(tenure.isNotNull(), F.lit(label))
    return band


def risk_tier(p: Column) -> Column:
    """Left-closed tiers; null outside [0, 1]."""
    tier = F.when(p < 0, F.lit(None).cast("string"))
    for label, end in D.RISK_TIERS:
        tier = tier.when(p < end, F.lit(label))
    return tier


def tier_order(tier: Column) -> Column:
    """1..4 in order of risk, 0 for an unknown label."""
    return F.coalesce(
        F.array_position(F.array(*[F.lit(t) for t, _ in D.RISK_TIERS]), tier).cast("int"), F.lit(0))


def probability_bucket(p: Column) -> Column:
    return F.floor(p * 10).cast("double") / 10


def status(churn: Column) -> Column:
    return F.when(churn == 1, "Churned").otherwise("Active")


def age_group(senior: Column) -> Column:
    return F.when(senior == 1, "Senior").otherwise("Under 65")


def household(partner: Column, dependents: Column) -> Column:
    return (F.when((partner == 1) & (dependents == 1), "Partner + dependents")
            .when(partner == 1, "Partner").when(dependents == 1, "Dependents").otherwise("Single"))


def payment_short(method: Column) -> Column:
    return F.substring_index(method, " (", 1)


def service_label(service: Column) -> Column:
    return F.initcap(F.replace(service, F.lit("_"), F.lit(" ")))


def add_features(df: DataFrame) -> DataFrame:
    def is_yes(c):
        return flag(F.col(c) == "Yes")

    out = df.withColumns({
        # a missing label differs from every label
        "has_internet": flag(~F.col("internet_service").eqNullSafe("No")),
        "multiple_lines_flag": is_yes("multiple_lines"),
        "n_addons": reduce(add, [is_yes(c) for c in D.ADDONS]),
        "has_protection_bundle": flag(reduce(add, [is_yes(c) for c in D.PROTECTION_ADDONS]) >= 2),
        "auto_pay": auto_pay(F.col("payment_method")),
        "contract_months": contract_months(F.col("contract")),
        "tenure_band": tenure_band(F.col("tenure")),
        "avg_historic_charge": F.when(
            F.col("tenure") > 0,
            ratio(F.col("total_charges"), F.greatest(F.col("tenure"), F.lit(1))),
        ).otherwise(F.col("monthly_charges").cast("double")),
        "is_new_customer": flag(F.col("tenure") <= 6),
        "family": flag((F.col("partner") == 1) | (F.col("dependents") == 1)),
        "fiber_no_support": flag((F.col("internet_service") == "Fiber optic")
                                 & ~F.col("tech_support").eqNullSafe("Yes")),
    })
    out = out.withColumns({
        "n_services": F.col("phone_service") + F.col("multiple_lines_flag")
        + F.col("has_internet") + F.col("n_addons"),
        "charge_drift": F.col("monthly_charges").cast("double") - F.col("avg_historic_charge"),
    })
    return out.withColumn(
        "charge_per_service",
        ratio(F.col("monthly_charges"), F.greatest(F.col("n_services"), F.lit(1))))


def build_features(raw: DataFrame) -> DataFrame:
    return add_features(clean(raw))


def log_total_charges(df: DataFrame) -> DataFrame:
    return df.withColumn("log_total_charges", F.log1p(F.col("total_charges").cast("double")))
