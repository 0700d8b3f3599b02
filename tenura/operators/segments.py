"""Customer segments: scaling, k-means, profile and readable names."""

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from tenura.functions import domain as D
from tenura.functions.numeric import mean_of
from tenura.operators import clusters
from tenura.session import spread, written_table

SCALED = [f"z_{c}" for c in D.SEGMENT_FEATURES]


def segment_features(df: DataFrame) -> DataFrame:
    """Z-scores (population deviation) of the seven features; contract length as log1p first.

    The moments are one aggregated row read as a scalar subquery. A constant feature scales to 0.
    """
    value = {c: F.log1p(F.col(c).cast("double")) if c == "contract_months" else F.col(c).cast("double")
             for c in D.SEGMENT_FEATURES}
    moments = df.agg(F.struct(
        *[F.avg(v).alias(f"m_{c}") for c, v in value.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in value.items()])).scalar()
    with_m = df.withColumn("_m", moments)
    return with_m.withColumns({
        f"z_{c}": F.coalesce(F.try_divide(v - F.col(f"_m.m_{c}"), F.col(f"_m.s_{c}")), F.lit(0.0))
        for c, v in value.items()}).drop("_m")


def segment_vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=SCALED, outputCol="z").transform(segment_features(df))


def best_runs(points: DataFrame, ks: list[int], starts: int, seed: int, key: str = "customer_id") -> dict[int, clusters.Run]:
    """Per k the best of several starts by within-cluster cost; all runs move in the same scans."""
    asked = [(k, seed + i) for k in ks for i in range(starts)]
    runs = clusters.fit_all(points, SCALED, asked, key)
    return {k: min((run for (mk, _), run in zip(asked, runs) if mk == k), key=lambda run: run.cost) for k in ks}


def scan_k(df: DataFrame, ks=range(2, 9), starts: int = 10, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Cost and silhouette (squared distances, all customers) per number of clusters."""
    points = spread(segment_features(df).select(key, *SCALED), key).cache()
    try:
        best = best_runs(points, list(ks), starts, seed, key)
        scores = clusters.silhouettes(points, SCALED, list(best.values()))
    finally:
        points.unpersist()
    rows = [(int(k), float(run.cost), float(s)) for (k, run), s in zip(best.items(), scores)]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def segment_customers(df: DataFrame, k: int = 4, starts: int = 20, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Cluster number per customer, numbered by mean tenure so that reruns agree. Centres are a few numbers; each
    customer compares them in plain columns."""
    vectors = segment_vectors(df)
    points = spread(vectors.select(key, *SCALED), key).cache()
    try:
        run = best_runs(points, [k], starts, seed, key)[k]
        if len(run.centres):
            run = clusters.settle(points, SCALED, {0: run.centres})[0]      # the chosen one as a close fixed point
    finally:
        points.unpersist()
    position = D.SEGMENT_FEATURES.index("tenure")
    centres = run.centres[run.centres[:, position].argsort(kind="stable")]
    if not len(centres):
        return vectors.withColumn("segment_id", F.lit(None).cast("int"))
    return vectors.withColumn("segment_id", clusters.nearest(SCALED, centres))


def segment_projection(vectors: DataFrame, key: str = "customer_id") -> DataFrame:
    """First two principal components (the z-scores are centred); the largest loading is positive."""
    model = PCA(k=2, inputCol="z", outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    pcs = vector_to_array(F.col("pc"))
    return model.transform(vectors).select(key, *[c for c in ("segment_id",) if c in vectors.columns],
                                           (pcs[0] * signs[0]).alias("pc1"), (pcs[1] * signs[1]).alias("pc2"))


def segment_profile(labelled: DataFrame) -> DataFrame:
    """Size, churn rate and raw means per segment."""
    return labelled.groupBy("segment_id").agg(
        F.count("*").alias("customers"), mean_of(F.col("churn")).alias("churn_rate"),
        *[mean_of(F.col(c)).alias(c) for c in D.SEGMENT_FEATURES]).orderBy(F.desc("churn_rate"), "segment_id")


def segment_names(profile: DataFrame, base: DataFrame) -> DataFrame:
    """Three-part name from a segment's means relative to the whole base."""
    overall = base.agg(F.struct(*[mean_of(F.col(c)).alias(c) for c in D.SEGMENT_FEATURES])).scalar()
    p = profile.withColumn("_all", overall)

    def whole(c):
        return F.col(f"_all.{c}")

    life = (F.when(F.col("tenure") < whole("tenure") * 0.6, "New")
            .when(F.col("tenure") > whole("tenure") * 1.3, "Loyal").otherwise("Mid-life"))
    contract = (F.when(F.col("contract_months") < 4, "month-to-month")
                .when(F.col("contract_months") > 12, "long contract").otherwise("mixed contract"))
    product = (F.when(F.col("has_internet") < 0.2, "phone-only")
               .when(F.col("n_addons") > whole("n_addons") * 1.3, "bundled")
               .when(F.col("monthly_charges") > whole("monthly_charges") * 1.15, "high spend")
               .otherwise("core internet"))
    return p.withColumn("segment_name", F.concat_ws(", ", life, contract, product)).drop("_all")


def disambiguate_names(named: DataFrame) -> DataFrame:
    """Segments that read the same get their payment habit, and if that is not enough their number.
    The windows run over segments."""
    same = Window.partitionBy("segment_name")
    habit = F.when(F.col("auto_pay") >= 0.5, "auto-pay").otherwise("manual pay")
    once = named.withColumn("_n", F.count("*").over(same)).withColumn(
        "segment_name", F.when(F.col("_n") > 1, F.concat_ws(", ", "segment_name", habit))
        .otherwise(F.col("segment_name")))
    return once.withColumn("_n", F.count("*").over(same)).withColumn(
        "segment_name", F.when(F.col("_n") > 1, F.concat("segment_name", F.lit(" #"), F.col("segment_id")))
        .otherwise(F.col("segment_name"))).drop("_n")


def name_segments(labelled: DataFrame) -> DataFrame:
    """Profile with final names."""
    return disambiguate_names(segment_names(segment_profile(labelled), labelled))


def label_with_names(labelled: DataFrame, profile: DataFrame) -> DataFrame:
    """Adds segment_name to every customer. The profile is written, so Catalyst joins it by its size."""
    names = written_table(labelled.sparkSession, profile.select("segment_id", "segment_name"))
    return labelled.join(names, "segment_id")
