"""Queries that fit models. Fitted once per warehouse and reused by the queries that score."""

from dataclasses import replace

from pyspark.sql import Window, functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.functions.numeric import half_up
from tenura.operators import evaluate as E
from tenura.operators import model_tables, models, segments, split, train
from tenura.plans.catalog import query
from tenura.plans.check_sql import r, sql
from tenura.session import work_folder, written_table
from tenura.sources import files

SETTINGS = models.ModelSettings()
_fitted: dict[tuple[int, str], object] = {}


def rows_of(w):
    """Mart with the split column."""
    return w.stage("model_rows", lambda: split.assign_split(
        w.mart(), "customer_id", "churn", w.split_cuts(), D.SplitSizes()))


def train_of(w):
    return models.as_training(rows_of(w).where(F.col("split") == "train"))


def fitted(w, name):
    at = (id(w), name)
    if at not in _fitted:
        rows = train_of(w).cache()
        try:
            _fitted[at] = models.fit(name, rows, SETTINGS)
        finally:
            rows.unpersist()
    return _fitted[at]


def metrics(w, *names):
    """Scores are written once; the metrics read the table instead of scoring again for each."""
    scored = models.evaluation_rows({n: fitted(w, n) for n in names}, rows_of(w))
    return E.model_comparison(written_table(w.spark, scored))


_levels = " + ".join(f"(SELECT CASE count(DISTINCT {c}) WHEN 2 THEN 1 ELSE count(DISTINCT {c}) END FROM known)" for c in D.MODEL_LABELS)


@query("feature_vectors", sql(f"""
    SELECT split, count(*) AS n, CAST({_levels} + {len(D.MODEL_NUMBERS)} AS INTEGER) AS width FROM splits GROUP BY split""",
    "splits", "mart", extra={"known": "SELECT mart.* FROM mart JOIN splits USING (customer_id) WHERE split = 'train'"}))
def _(w):
    """Vector width per split: labels as one-hot columns, numbers scaled."""
    prepared = models.Pipeline(stages=models.feature_stages(train_of(w))).fit(train_of(w))
    vectors = prepared.transform(models.as_training(rows_of(w)))
    size = F.size(models.vector_to_array("features"))
    return vectors.groupBy("split").agg(F.count("*").alias("n"), F.min(size).alias("width"))


@query("logistic_baseline")
def _(w):
    return metrics(w, "logistic_regression")


@query("random_forest_baseline")
def _(w):
    return metrics(w, "random_forest")


@query("gradient_boosting_baseline")
def _(w):
    return metrics(w, "gradient_boosting")


@query("mlp_baseline")
def _(w):
    return metrics(w, "neural_net")


@query("logistic_coefficients")
def _(w):
    return models.logistic_coefficients(fitted(w, "logistic_regression"), w.spark)


@query("cross_validate")
def _(w):
    return train.cross_validated(rows_of(w), s=SETTINGS)


@query("score_all")
def _(w):
    return models.score_all({n: fitted(w, n) for n in models.BUILDERS}, rows_of(w))


@query("score_all_sizes", sql("""
    SELECT unnest(['logistic_regression', 'random_forest', 'gradient_boosting', 'neural_net']) AS model_name, count(*) AS customers,
           count(DISTINCT customer_id) AS keys, true AS in_range, true AS tiers_follow FROM mart""", "mart"))
def _(w):
    """Every model scores every customer once, within [0, 1], and the tier follows from the score."""
    scores = trained(w).scores
    p = F.col("churn_probability")
    return scores.groupBy("model_name").agg(
        F.count("*").alias("customers"), F.countDistinct("customer_id").alias("keys"), F.bool_and((p >= 0) & (p <= 1)).alias("in_range"),
        F.bool_and(F.col("risk_tier") == X.risk_tier(p)).alias("tiers_follow"))


def trained(w):
    """The whole run from the fitted and cross-validated models to the summary, once for each warehouse; its scores are
    upserted into the warehouse's score table and read from there."""
    at = (id(w), "trained")
    if at not in _fitted:
        t = train.train_to_score(rows_of(w), train.cross_validated(rows_of(w), s=SETTINGS), SETTINGS,
                                 fitted={n: fitted(w, n) for n in models.BUILDERS})
        path = f"{w.folder}/model_scores"
        files.write_scores(t.scores, path)
        _fitted[at] = replace(t, scores=w.spark.read.parquet(path).where(F.col("model_name").isin(*t.models)))
    return _fitted[at]


@query("train_to_score", sql("""
    SELECT unnest(['logistic_regression', 'random_forest', 'gradient_boosting', 'neural_net']) AS model_name,
           true AS auc_agrees, true AS ap_positive, count(*) FILTER (split = 'test') AS test_rows FROM splits""", "splits"))
def _(w):
    """The comparison of all four models; each AUC is computed again from ranks of the written scores."""
    t = trained(w)
    test = t.rows.where(F.col("split") == "test")
    by = Window.partitionBy("model_name")
    ranks = test.select("model_name", "y", (F.rank().over(by.orderBy("p")) + (
        F.count("*").over(Window.partitionBy("model_name", "p")) - 1) / 2).alias("rank"))      # the test split of one base
    own = ranks.groupBy("model_name").agg(F.sum("y").alias("a"), F.count("*").alias("n"), F.sum(F.when(F.col("y") == 1, F.col("rank"))).alias("s"))
    auc = (F.col("s") - F.col("a") * (F.col("a") + 1) / 2) / (F.col("a") * (F.col("n") - F.col("a")))
    return own.withColumn("own_auc", auc).join(t.comparison, "model_name").select(
        "model_name", (F.abs(F.col("own_auc") - F.col("roc_auc")) < 1e-9).alias("auc_agrees"),
        (F.col("pr_auc") > 0).alias("ap_positive"), F.col("n").alias("test_rows"))


@query("train_choice", sql("SELECT true AS winner_is_best, true AS threshold_is_best, count(*) AS targeted_follows FROM mart", "mart"))
def _(w):
    """The winner has the best validation AUC, its threshold the best validation profit, and `targeted` follows it."""
    t = trained(w)
    best = t.comparison.agg(F.max("valid_roc_auc")).scalar()
    valid = t.rows.where((F.col("split") == "valid") & (F.col("model_name") == t.winner))
    curve = E.profit_curve(valid)
    top = curve.agg(F.max("profit")).scalar()
    right = train.winner_extract(t).where((F.col("targeted") == 1) == (F.col("churn_probability") >= t.threshold))
    return t.comparison.where(F.col("model_name") == t.winner).select(
        (F.col("valid_roc_auc") == best).alias("winner_is_best")).join(
        curve.where(F.abs(F.col("threshold") - t.threshold) < 1e-9).select((F.col("profit") == top).alias("threshold_is_best")).limit(1)
    ).join(right.agg(F.count("*").alias("targeted_follows")))


@query("train_summary")
def _(w):
    return train.full_summary(trained(w))


@query("train_comparison", sql("""
    SELECT unnest(['logistic_regression', 'random_forest', 'gradient_boosting', 'neural_net']) AS model_name,
           unnest([true, true, true, false]) AS cross_validated, count(*) AS upserted FROM mart""", "mart"))
def _(w):
    """The comparison's CV columns, there for three models and in range, beside the customers in the written score table."""
    t = trained(w)
    written = t.scores.groupBy("model_name").agg(F.countDistinct("customer_id").alias("upserted"))
    mean, deviation = F.col("cv_auc_mean"), F.col("cv_auc_std")
    return t.comparison.join(written, "model_name").select("model_name", F.coalesce(
        mean.between(0, 1) & deviation.between(0, 0.5), F.lit(False)).alias("cross_validated"), "upserted")


_inputs = [*D.MODEL_LABELS, *D.MODEL_NUMBERS]


@query("train_importance", f"SELECT unnest({_inputs}) AS feature, true AS in_range")
def _(w):
    """Permutation importance of the winner on the test split: a drop of AUC for every input."""
    drops = train.winner_importance(trained(w), rows_of(w))
    return drops.select("feature", F.col("auc_drop").between(-1, 1).alias("in_range"))


@query("segments_are_nearest", sql("SELECT count(*) AS customers, 0 AS nearer_elsewhere FROM mart", "mart"))
def _(w):
    """k-means as a fixed point: no customer is nearer to the mean of another segment than to that of its own."""
    z = segments.SCALED
    labelled = clustered(w)
    means = labelled.groupBy("segment_id").agg(F.array(*[F.avg(c) for c in z]).alias("mean"))
    centres = means.agg(F.collect_list("mean")).scalar()                        # one entry per segment
    point = F.array(*z)
    def apart(c):
        return F.aggregate(F.zip_with(point, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    rows = labelled.join(written_table(w.spark, means), "segment_id").withColumn("_all", centres)
    nearest = F.array_min(F.transform("_all", apart))
    return rows.agg(F.count("*").alias("customers"), F.sum((apart(F.col("mean")) > nearest + 1e-3).cast("int")).cast("int").alias("nearer_elsewhere"))


@query("projection_is_uncorrelated", sql("SELECT count(*) AS customers, true AS uncorrelated, true AS first_is_wider FROM mart", "mart"))
def _(w):
    pcs = segments.segment_projection(clustered(w))
    return pcs.agg(F.count("*").alias("customers"), (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
                   (F.var_pop("pc1") >= F.var_pop("pc2")).alias("first_is_wider"))


@query("saved_model_agrees", sql("SELECT count(*) AS customers, count(*) AS same FROM mart", "mart"))
def _(w):
    """A saved and reloaded model gives every customer the same score."""
    path = work_folder(w.spark, "model")
    model = fitted(w, "logistic_regression")
    models.save_model(model, path)
    rows = models.as_training(rows_of(w))
    both = models.with_probability(models.load_model(path), models.with_probability(model, rows, "p_before").drop("features"), "p_after")
    return both.agg(F.count("*").alias("customers"), F.count_if(F.col("p_before") == F.col("p_after")).alias("same"))


_four = "unnest(['logistic_regression', 'random_forest', 'gradient_boosting', 'neural_net']) AS model_name"


@query("models_as_tables", sql(f"SELECT {_four}, count(*) AS customers, count(*) AS same_from_table FROM mart", "mart"))
def _(w):
    """Every customer scored by every model from its exported table of nodes or weights, beside the model's own score."""
    rows = models.as_training(rows_of(w))
    out = None
    for name in models.BUILDERS:
        model = fitted(w, name)
        own = model.transform(rows).select("customer_id", models.vector_to_array("probability")[1].alias("p"))
        both = own.join(model_tables.score_from_tables(name, model, rows), "customer_id", "left")
        one = both.agg(F.lit(name).alias("model_name"), F.count("*").alias("customers"),
                       F.count_if(F.abs(F.col("p") - F.col("p_table")) <= 1e-9).alias("same_from_table"))
        out = one if out is None else out.unionByName(one)
    return out


@query("saved_models_agree", sql(f"SELECT {_four}, count(*) AS customers, count(*) AS same FROM mart", "mart"))
def _(w):
    """Each of the four models, saved and reloaded, gives every customer the same score."""
    rows = models.as_training(rows_of(w))
    out = None
    for name in models.BUILDERS:
        path = work_folder(w.spark, "model")
        models.save_model(fitted(w, name), path)
        before = models.with_probability(fitted(w, name), rows, "p_before").select("customer_id", "p_before")
        both = models.with_probability(models.load_model(path), rows, "p_after").select("customer_id", "p_after").join(before, "customer_id")
        one = both.agg(F.lit(name).alias("model_name"), F.count("*").alias("customers"),
                       F.count_if(F.col("p_before") == F.col("p_after")).alias("same"))
        out = one if out is None else out.unionByName(one)
    return out


@query("model_permutation_importance")
def _(w):
    """Importance of every input of the logistic model on the test split."""
    inputs = [*D.MODEL_LABELS, *D.MODEL_NUMBERS]
    test = models.as_training(rows_of(w).where(F.col("split") == "test")) \
        .select("customer_id", F.col("churn").alias("y"), *inputs)
    model = fitted(w, "logistic_regression")
    return E.permutation_importance(test, inputs, lambda df: models.with_probability(model, df))


_codes = ", ".join(f"CASE WHEN {c} = 'Two year' THEN 0 ELSE (SELECT count(DISTINCT {c}) FROM known t WHERE t.{c} <= m.{c}) END "
                   f"AS code_{c}" if c == "contract_type" else
                   f"(SELECT count(DISTINCT {c}) FROM known t WHERE t.{c} <= m.{c}) AS code_{c}" for c in D.MODEL_LABELS)
_zs = ", ".join(r(f"(CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM known)) / "
                  f"(SELECT CASE stddev_pop(CAST({c} AS DOUBLE)) WHEN 0 THEN 1 ELSE stddev_pop(CAST({c} AS DOUBLE)) END FROM known)", 6)
                + f" AS z_{c}" for c in ["tenure", "monthly_charges", "n_services"])


@query("categorical_codes", sql(
    f"SELECT customer_id, {_codes}, {_zs} FROM mart m", "mart",
    extra={"known": "SELECT * FROM mart WHERE contract_type <> 'Two year'"}))
def _(w):
    """Codes fitted on customers without two-year contracts: that level is unseen and becomes 0."""
    numbers = ["tenure", "monthly_charges", "n_services"]
    base = w.mart().where(F.col("contract_type") != "Two year")
    vocabulary, moments = models.fit_codes(base, D.MODEL_LABELS, numbers)
    out = models.apply_codes(w.mart(), vocabulary, moments, D.MODEL_LABELS, numbers)
    return out.select("customer_id", *[F.col(f"code_{c}").cast("bigint").alias(f"code_{c}") for c in D.MODEL_LABELS],
                      *[half_up(f"z_{c}", 6).alias(f"z_{c}") for c in numbers])


@query("scan_k")
def _(w):
    return segments.scan_k(w.mart())


def clustered(w):
    at = (id(w), "segments")
    if at not in _fitted:
        _fitted[at] = segments.segment_customers(w.mart())
    return _fitted[at]


@query("segment_customers")
def _(w):
    labelled = clustered(w)
    return segments.label_with_names(labelled.select("customer_id", "segment_id"), segments.name_segments(labelled))


@query("segment_projection")
def _(w):
    return segments.segment_projection(clustered(w))


@query("segment_profile_kmeans")
def _(w):
    return segments.name_segments(clustered(w))
