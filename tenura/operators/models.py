"""Churn classifiers on MLlib: preparation, fitting, scoring, cross validation.

Training and scoring are distributed MLlib jobs over the staged mart. The driver holds fitted models
and one row per model, nothing that grows with the customers.
"""

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from tenura.functions import domain as D
from tenura.functions.numeric import half_up
from tenura.operators import scoring
from tenura.operators.ordering import hash_order
from tenura.session import in_parallel, spread, written_table


@dataclass(frozen=True)
class ModelSettings:
    """Settings of the four models (fixed default values)."""

    logistic_c: float = 0.5
    logistic_iterations: int = 2000
    forest_trees: int = 500
    forest_depth: int = 10
    forest_leaf: int = 10
    forest_memory_mb: int = 1024    # split statistics that a task holds; what does not fit takes another pass
    boost_rate: float = 0.05
    boost_iterations: int = 400
    boost_depth: int = 4
    boost_leaf: int = 40
    boost_valid: float = 0.15
    boost_tolerance: float = 0.0001
    net_hidden: tuple[int, ...] = (128, 64)
    net_iterations: int = 200
    seed: int = 42


@dataclass(frozen=True)
class Inputs:
    labels: list[str] = field(default_factory=lambda: list(D.MODEL_LABELS))
    numbers: list[str] = field(default_factory=lambda: list(D.MODEL_NUMBERS))
    target: str = "churn"


def as_training(df: DataFrame, inputs: Inputs = Inputs()) -> DataFrame:
    """Numbers as doubles (MLlib takes no decimals), target as double label."""
    out = df.withColumns({c: F.col(c).cast("double") for c in inputs.numbers})
    return out.withColumn("label", F.col(inputs.target).cast("double")) if inputs.target in df.columns else out


def feature_stages(train: DataFrame, inputs: Inputs = Inputs(), scale: bool = True) -> list:
    """Stages that turn labels and numbers into one vector.

    One-hot per level; a level never seen in training becomes all zeros (the indexer's extra slot is
    the one the encoder drops); a two-level feature keeps one column. Numbers are standardised for
    linear models and nets, left alone for trees.
    """
    indexer = StringIndexer(inputCols=inputs.labels, outputCols=[f"i_{c}" for c in inputs.labels],
                            handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
    encoder = OneHotEncoder(inputCols=[f"i_{c}" for c in inputs.labels],
                            outputCols=[f"o_{c}" for c in inputs.labels], dropLast=True)
    stages, parts = [indexer, encoder], []
    for column, levels in zip(inputs.labels, indexer.labelsArray):
        if len(levels) == 2:
            stages.append(VectorSlicer(inputCol=f"o_{column}", outputCol=f"b_{column}", indices=[1]))
            parts.append(f"b_{column}")
        else:
            parts.append(f"o_{column}")
    stages.append(VectorAssembler(inputCols=inputs.numbers, outputCol="numbers"))
    if scale:
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=[*parts, "scaled" if scale else "numbers"], outputCol="features"))
    return stages


def feature_names(prepared: PipelineModel, inputs: Inputs = Inputs()) -> list[str]:
    """Names of the vector's positions."""
    indexer = prepared.stages[0]
    names = []
    for column, levels in zip(inputs.labels, indexer.labelsArray):
        kept = levels[1:] if len(levels) == 2 else levels
        names += [f"{column}_{level}" for level in kept]
    return names + list(inputs.numbers)


def logistic_baseline(train: DataFrame, s: ModelSettings = ModelSettings(), inputs: Inputs = Inputs()) -> Pipeline:
    """L2-penalised logistic regression: C over summed loss equals 1 / (C n) over mean loss."""
    n = train.count()
    clf = LogisticRegression(regParam=1.0 / (s.logistic_c * max(n, 1)), elasticNetParam=0.0, standardization=False,
                             maxIter=s.logistic_iterations, tol=1e-8)
    return Pipeline(stages=[*feature_stages(train, inputs), clf])


def random_forest_baseline(train: DataFrame, s: ModelSettings = ModelSettings(), inputs: Inputs = Inputs()) -> Pipeline:
    clf = RandomForestClassifier(numTrees=s.forest_trees, maxDepth=s.forest_depth, minInstancesPerNode=s.forest_leaf,
                                 featureSubsetStrategy="sqrt", maxMemoryInMB=s.forest_memory_mb, cacheNodeIds=True, seed=s.seed)
    return Pipeline(stages=[*feature_stages(train, inputs, scale=False), clf])


def gradient_boosting_baseline(train: DataFrame, s: ModelSettings = ModelSettings(),
                               inputs: Inputs = Inputs()) -> Pipeline:
    """Boosted trees that stop when the held-out part (column held_out) no longer gains."""
    clf = GBTClassifier(stepSize=s.boost_rate, maxIter=s.boost_iterations, maxDepth=s.boost_depth,
                        minInstancesPerNode=s.boost_leaf, validationIndicatorCol="held_out",
                        validationTol=s.boost_tolerance, seed=s.seed)
    return Pipeline(stages=[*feature_stages(train, inputs, scale=False), clf])


def hold_out(train: DataFrame, fraction: float, seed, key: str = "customer_id") -> DataFrame:
    """Marks about `fraction` of the rows by hash, the same rows on any partitioning."""
    slot = F.conv(F.substring(hash_order(f"held{seed}", key), 1, 6), 16, 10).cast("bigint")
    return train.withColumn("held_out", slot < int(fraction * 16 ** 6))


def mlp_baseline(train: DataFrame, s: ModelSettings = ModelSettings(), inputs: Inputs = Inputs()) -> Pipeline:
    """Neural net with two hidden layers."""
    stages = feature_stages(train, inputs)
    width = len(feature_names(Pipeline(stages=stages[:1]).fit(train), inputs))
    clf = MultilayerPerceptronClassifier(layers=[width, *s.net_hidden, 2], maxIter=s.net_iterations, seed=s.seed)
    return Pipeline(stages=[*stages, clf])


BUILDERS = {
    "logistic_regression": logistic_baseline,
    "random_forest": random_forest_baseline,
    "gradient_boosting": gradient_boosting_baseline,
    "neural_net": mlp_baseline,
}


FIT_TASKS = 8               # at least, if there are as many shuffle partitions
FIT_ROWS = 100_000          # training rows of a task


def fit_tasks(train: DataFrame) -> int:
    """Tasks that share the training rows. A fit is thousands of short jobs, and every task of each costs the driver some
    milliseconds: their number follows the rows, in full rounds of the cores. Shuffle partitions, meant for whole tables,
    bound it."""
    spark = train.sparkSession
    most, cores = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    rounds = -(-max(FIT_TASKS, -(-train.count() // FIT_ROWS)) // cores)
    return min(most, rounds * cores)


def fit(name: str, train: DataFrame, s: ModelSettings = ModelSettings(), inputs: Inputs = Inputs()) -> PipelineModel:
    """Fit one model on rows that went through `as_training`. They are dealt anew once, because a small table comes as
    one file and every pass would run in one task."""
    rows = hold_out(train, s.boost_valid, s.seed) if name == "gradient_boosting" else train
    rows = spread(rows, "customer_id", fit_tasks(train)).cache()
    try:
        return BUILDERS[name](rows, s, inputs).fit(rows)
    finally:
        rows.unpersist()


def with_probability(model: Transformer, df: DataFrame, out: str = "p") -> DataFrame:
    """Adds the churn probability, five digits."""
    scored = model.transform(df)
    return scored.select(*df.columns, half_up(vector_to_array("probability")[1], 5).alias(out))


def score_all(models: dict[str, Transformer], df: DataFrame) -> DataFrame:
    """Score table of every customer and model."""
    rows = as_training(df)
    frames = [scoring.score_rows(with_probability(m, rows), name, F.col("p")) for name, m in models.items()]
    return scoring.all_model_scores(frames)


def evaluation_rows(models: dict[str, Transformer], df: DataFrame) -> DataFrame:
    """model_name, y, p, monthly_charges, split per customer and model, for the metrics."""
    rows = as_training(df)
    out = None
    for name, m in models.items():
        one = with_probability(m, rows).select(
            "customer_id", F.lit(name).alias("model_name"), F.col("churn").cast("int").alias("y"), "p",
            F.col("monthly_charges").cast(D.MONEY).alias("monthly_charges"), "split")
        out = one if out is None else out.unionByName(one)
    return out


def cross_validate(names: list[str], train: DataFrame, folds: int = 5, s: ModelSettings = ModelSettings(),
                   inputs: Inputs = Inputs()) -> DataFrame:
    """AUC mean and population deviation over given folds (column fold), one row per model.

    All (model, fold) fits run side by side; preparation is fitted inside each fold.
    """
    def one(name, fold):
        def run():
            part = train.where(F.col("fold") != fold)
            part = hold_out(part, s.boost_valid, s.seed) if name == "gradient_boosting" else part
            model = BUILDERS[name](part, s, inputs).fit(part)
            judge = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="label",
                                                  metricName="areaUnderROC", numBins=0)
            return judge.evaluate(model.transform(train.where(F.col("fold") == fold)))
        return run

    scores = in_parallel([one(n, f) for n in names for f in range(folds)], threads=4)
    rows = [(n, float(a)) for n, a in zip([n for n in names for _ in range(folds)], scores)]
    return train.sparkSession.createDataFrame(rows, "model_name string, auc double").groupBy("model_name").agg(
        F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std"))


def logistic_coefficients(model: PipelineModel, spark, inputs: Inputs = Inputs()) -> DataFrame:
    """Coefficient and odds ratio per vector position, largest effect first."""
    names = feature_names(model, inputs)
    rows = [(n, float(c)) for n, c in zip(names, model.stages[-1].coefficients.toArray())]
    table = spark.createDataFrame(rows, "feature string, coef double")
    return table.withColumn("odds_ratio", F.exp("coef")).orderBy(F.desc(F.abs("coef")), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- label codes
def fit_codes(df: DataFrame, labels: list[str], numbers: list[str]) -> tuple[DataFrame, DataFrame]:
    """Vocabulary (feature, level, code 1..k in alphabetical order) and one row of moments.

    The dense rank runs over the distinct levels of a feature.
    """
    levels = df.select([F.col(c).cast("string").alias(c) for c in labels]) \
        .unpivot([], labels, "feature", "level").where(F.col("level").isNotNull()).distinct()
    vocabulary = levels.withColumn(
        "code", F.row_number().over(Window.partitionBy("feature").orderBy("level")))
    moments = df.agg(F.struct(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in numbers],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in numbers]).alias("moments"))
    return vocabulary, moments


def apply_codes(df: DataFrame, vocabulary: DataFrame, moments: DataFrame, labels: list[str],
                numbers: list[str]) -> DataFrame:
    """Labels to codes (0 for a level the fit has not seen), numbers to z-scores.

    The vocabulary is written, so a feature's levels are joined by their real size: broadcast if few, by
    shuffle if a feature has very many.
    """
    vocabulary = written_table(df.sparkSession, vocabulary)
    out = df.withColumn("_m", moments.scalar())
    coded = {}
    for i, c in enumerate(labels):
        levels = vocabulary.where(F.col("feature") == c).select(F.col("level").alias(f"_level{i}"), F.col("code").alias(f"_code{i}"))
        out = out.join(levels, F.col(c).cast("string") == F.col(f"_level{i}"), "left").drop(f"_level{i}")
        coded[f"code_{c}"] = F.coalesce(F.col(f"_code{i}"), F.lit(0))
    scaled = {f"z_{c}": (F.col(c).cast("double") - F.col(f"_m.m_{c}"))
              / F.when(F.col(f"_m.s_{c}") == 0, 1.0).otherwise(F.col(f"_m.s_{c}")) for c in numbers}
    return out.withColumns({**coded, **scaled}).drop("_m", *[f"_code{i}" for i in range(len(labels))])
