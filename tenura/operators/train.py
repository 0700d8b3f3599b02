"""From rows with a split to scored customers: fit, cross-validate, compare, pick, price, score, summarise."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tenura.functions import features as X
from tenura.functions.domain import Economics
from tenura.operators import evaluate as E
from tenura.operators import models, scoring, split
from tenura.session import in_parallel, written_table

CROSS_VALIDATED = ("logistic_regression", "random_forest", "gradient_boosting")


@dataclass
class Training:
    """What a training run leaves behind; tables are written, so reading them costs no fit."""

    models: dict[str, PipelineModel]
    rows: DataFrame             # model_name, y, p, monthly_charges, split of every customer and model
    comparison: DataFrame       # test metrics, validation AUC, cross-validated AUC where there is one
    winner: str
    threshold: float
    scores: DataFrame           # score table of all models


def fit_all(rows: DataFrame, names=tuple(models.BUILDERS), s: models.ModelSettings = models.ModelSettings(),
            inputs: models.Inputs = models.Inputs()) -> dict[str, PipelineModel]:
    """All models on the training split, fitted side by side."""
    train = models.as_training(rows.where(F.col("split") == "train"), inputs).cache()
    try:
        fits = in_parallel([lambda n=n: models.fit(n, train, s, inputs) for n in names], threads=2)
    finally:
        train.unpersist()
    return dict(zip(names, fits))


def cross_validated(rows: DataFrame, names=CROSS_VALIDATED, folds: int = 5, s: models.ModelSettings = models.ModelSettings(),
                    inputs: models.Inputs = models.Inputs()) -> DataFrame:
    """Mean and deviation of the AUC over stratified folds of the training split, one row per model."""
    folded = split.stratified_folds(rows.where(F.col("split") == "train"), folds=folds)
    train = models.as_training(folded, inputs).cache()
    try:
        return models.cross_validate(list(names), train, folds, s, inputs)
    finally:
        train.unpersist()


def compare(scored: DataFrame, cv: DataFrame | None = None) -> DataFrame:
    """The comparison table with cv_auc_mean and cv_auc_std, null for models without cross validation."""
    out = E.model_comparison(scored)
    if cv is None:
        return out.withColumns({c: F.lit(None).cast("double") for c in ("cv_auc_mean", "cv_auc_std")})
    return out.join(cv, "model_name", "left").orderBy(F.desc("valid_roc_auc"), "model_name")


def choose(scored: DataFrame, econ: Economics = Economics()) -> tuple[str, float]:
    """Best model by validation AUC (first name on ties) and the threshold with the highest validation
    profit. Two values, read by the driver."""
    valid = scored.where(F.col("split") == "valid")
    aucs = E.auc_of_counts(E.score_counts(valid), ["model_name"], "valid_roc_auc")
    winner = E.select_best_model(aucs).first()["model_name"]
    curve = E.profit_curve(valid.where(F.col("model_name") == winner), econ)
    return winner, E.best_threshold(curve).first()["threshold"]


def score_rows(scored: DataFrame) -> DataFrame:
    """Score table from rows that carry a probability."""
    return scored.select(
        "customer_id", "model_name", F.col("p").alias("churn_probability"), X.risk_tier(F.col("p")).alias("risk_tier"),
        F.current_timestamp().alias("scored_at"))


def train_to_score(rows: DataFrame, cv: DataFrame | None = None, s: models.ModelSettings = models.ModelSettings(),
                   inputs: models.Inputs = models.Inputs(), econ: Economics = Economics(), fitted: dict | None = None) -> Training:
    """Fit (unless given), score everybody once, and derive the rest from the written scores."""
    fits = fitted or fit_all(rows, s=s, inputs=inputs)
    scored = written_table(rows.sparkSession, models.evaluation_rows(fits, rows))
    winner, threshold = choose(scored, econ)
    return Training(fits, scored, compare(scored, cv), winner, threshold, score_rows(scored))


def winner_extract(t: Training) -> DataFrame:
    """Score extract of the winner; `targeted` follows the chosen threshold."""
    rows = t.rows.where(F.col("model_name") == t.winner).select(
        "customer_id", "model_name", F.col("p").alias("churn_probability"),
        X.risk_tier(F.col("p")).alias("risk_tier"), F.current_timestamp().alias("scored_at"), "split")
    return scoring.score_extract(rows, t.winner, t.threshold)


def winner_importance(t: Training, rows: DataFrame, inputs: models.Inputs = models.Inputs()) -> DataFrame:
    """Permutation importance of the winner's inputs on the test split."""
    names = [*inputs.labels, *inputs.numbers]
    test = models.as_training(rows.where(F.col("split") == "test"), inputs) \
        .select("customer_id", F.col("churn").alias("y"), *names)
    return E.permutation_importance(test, names, lambda df: models.with_probability(t.models[t.winner], df))


def full_summary(t: Training, econ: Economics = Economics()) -> DataFrame:
    """One row: winner, threshold, all test metrics at it, campaign against contacting all, economics, models, and the
    whole comparison with its cross-validated AUC."""
    mine = t.rows.where(F.col("model_name") == t.winner)
    test = mine.where(F.col("split") == "test")
    metrics = E.classification_metrics(test, t.threshold)
    money = E.campaign_vs_contact_all(mine.where(F.col("split") == "valid"), test, econ).drop("threshold")
    names = t.rows.agg(F.array_sort(F.collect_set("model_name"))).scalar()      # one entry per model
    out = metrics.join(money, "model_name").withColumnRenamed("model_name", "best_model").withColumns({
        "offer_cost": F.lit(float(econ.offer_cost)), "months_saved": F.lit(float(econ.months_saved)),
        "success_rate": F.lit(float(econ.success_rate)), "models": names})
    whole = t.comparison.agg(F.array_sort(F.collect_list(F.struct(*t.comparison.columns))).alias("comparison"))  # one entry per model
    out = out.crossJoin(whole)
    return out.withColumn("summary", F.to_json(F.struct(*out.columns)))
