"""Scorecards, score tables and the rule-based segment label."""

from pyspark.sql import Column, DataFrame, functions as F

from tenura.functions import features as X
from tenura.functions.numeric import half_up

MAX_POINTS = 140
TENURE_CAP = 60


def tenure_points() -> Column:
    return TENURE_CAP - F.least(F.col("tenure"), F.lit(TENURE_CAP))


def key_points() -> Column:
    return (F.col("customer_id").cast("bigint") % 25).cast("int")


def score_points(contract="contract_type", tenure=None, internet="internet_service",
                 payment="payment_method", noise=None) -> Column:
    """Fixed integer scorecard: higher points, higher risk."""
    return (
        F.when(F.col(contract) == "Month-to-month", 30).when(F.col(contract) == "One year", 10).otherwise(0)
        + (tenure if tenure is not None else tenure_points())
        + F.when(F.col(internet) == "Fiber optic", 10).otherwise(0)
        + F.when(F.col(payment) == "Electronic check", 15).otherwise(0)
        + (noise if noise is not None else key_points())
    )


def scorecards(mart: DataFrame) -> DataFrame:
    """Score every customer with the two scorecards; p has five digits and everything derives from it.

    Both scores come from one pass over the mart (explode of two structs), not from a union of two.
    """
    cards = F.array(
        F.struct(F.lit("scorecard").alias("model_name"),
                 half_up(score_points() / MAX_POINTS, 5).alias("churn_probability")),
        F.struct(F.lit("scorecard_tenure").alias("model_name"),
                 half_up(tenure_points() / TENURE_CAP, 5).alias("churn_probability")),
    )
    return mart.select(
        "customer_id", "churn", "monthly_charges", "tenure", "split", F.explode(cards).alias("c"),
    ).select(
        "customer_id", "c.model_name", "c.churn_probability",
        X.risk_tier(F.col("c.churn_probability")).alias("risk_tier"),
        F.current_timestamp().alias("scored_at"), "churn", "monthly_charges", "tenure", "split")


def score_rows(df: DataFrame, model: str, probability: Column, scored_at: Column | None = None) -> DataFrame:
    """Rows of the score table for any frame that carries a probability."""
    p = half_up(probability, 5)
    return df.select(
        "customer_id", F.lit(model).alias("model_name"), p.alias("churn_probability"),
        X.risk_tier(p).alias("risk_tier"),
        (scored_at if scored_at is not None else F.current_timestamp()).alias("scored_at"))


def all_model_scores(frames: list[DataFrame]) -> DataFrame:
    """One long score table from the per-model frames."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def score_extract(scored: DataFrame, model: str, threshold: float = 0.40) -> DataFrame:
    """Scores of one model with its split and the campaign flag."""
    return scored.where(F.col("model_name") == model).select(
        "customer_id", "model_name", "churn_probability", "risk_tier", "scored_at", "split",
        (F.col("churn_probability") >= threshold).cast("int").alias("targeted"))


def attach_scores_segments(c360: DataFrame, scores: DataFrame | None,
                           segments: DataFrame | None) -> DataFrame:
    """Report data: the 360 view with score and segment columns.

    Left joins on the customer key keep every customer. A missing table gives the default labels.
    """
    out = c360
    if scores is not None:
        out = out.join(scores.select("customer_id", "churn_probability", "risk_tier", "split"),
                       "customer_id", "left")
    else:
        out = out.withColumns({"churn_probability": F.lit(None).cast("double"),
                               "risk_tier": F.lit("Unscored"), "split": F.lit("n/a")})
    if segments is not None:
        out = out.join(segments.select("customer_id", "segment_name"), "customer_id", "left")
    else:
        out = out.withColumn("segment_name", F.lit("n/a"))
    return out.select(
        "customer_id", "gender", "senior_citizen", "partner", "dependents", "contract_type",
        "payment_method", "internet_service", "tenure", "tenure_band", "n_services",
        "monthly_charges", "total_charges", "churn", "churn_probability", "risk_tier",
        "segment_name", "split")


def rule_segment() -> Column:
    """Segment 0..3 from product and contract."""
    return (F.when(F.col("has_internet") == 0, 1)
            .when(F.col("contract_months") == 1, F.when(F.col("auto_pay") == 1, 0).otherwise(3))
            .otherwise(2))
