import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from tenura.operators import clusters

COLUMNS = ["x", "y", "z"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0, 0], [4, 0, 1], [0, 5, 2], [6, 6, 0]])
    rows = centres[rng.integers(4, size=600)] + rng.normal(0, 0.8, (600, 3))
    df = spark.createDataFrame([(f"k{i}", *map(float, r)) for i, r in enumerate(rows)], ["customer_id", *COLUMNS]).repartition(3).cache()
    return df, rows


def lloyd(rows, centres, iterations=100):
    """k-means by itself, from the same centres."""
    for _ in range(iterations):
        at = ((rows[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([rows[at == c].mean(axis=0) if (at == c).any() else centres[c] for c in range(len(centres))])
        if np.abs(new - centres).max() < 1e-9:
            break
        centres = new
    return centres, ((rows[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_runs_together_cost_what_they_cost_alone(points):
    df, rows = points
    starts = {i: clusters.first_centres(rows, k, i) for i, k in enumerate([1, 2, 3, 4, 5, 5, 8])}
    for i, run in clusters.settle(df, COLUMNS, starts, tolerance=1e-9).items():
        centres, cost = lloyd(rows, starts[i])
        assert run.cost == pytest.approx(cost, rel=1e-9) and np.allclose(run.centres, centres)
        assert run.sizes.sum() == 600 and np.allclose(run.totals.sum(axis=0), rows.sum(axis=0))


def test_costs_beside_single_fits(points):
    df, rows = points
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(df)
    for k in (2, 4):
        best = min(r.cost for r in clusters.fit_all(df, COLUMNS, [(k, s) for s in range(10)]))
        single = min(KMeans(k=k, seed=s, featuresCol="v").fit(vectors).summary.trainingCost for s in range(3))
        assert best <= single * 1.001


def test_silhouettes_are_sparks(points):
    df, rows = points
    runs = clusters.fit_all(df, COLUMNS, [(k, 1) for k in (2, 3, 4, 6)])
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(df)
    judge = ClusteringEvaluator(featuresCol="v", predictionCol="c")
    for run, got in zip(runs, clusters.silhouettes(df, COLUMNS, runs)):
        labelled = vectors.withColumn("c", clusters.nearest(COLUMNS, run.centres))
        assert got == pytest.approx(judge.evaluate(labelled), abs=1e-9)


def test_few_points_ties_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0), ("c", 3.0, 1.0, 1.0)], ["customer_id", *COLUMNS])
    two, five = clusters.fit_all(df, COLUMNS, [(2, 0), (5, 0)])
    assert two.cost == 0 and five.cost == 0 and len(five.centres) == 2            # no more centres than different points
    assert clusters.silhouettes(df, COLUMNS, [two])[0] == pytest.approx(2 / 3)      # a point alone counts 0
    one = clusters.fit_all(df, COLUMNS, [(1, 0)])
    assert clusters.silhouettes(df, COLUMNS, one) == [0.0]
    tie = df.select(clusters.nearest(["x"], np.array([[0.0], [2.0]])).alias("c")).collect()
    assert [r.c for r in tie] == [0, 0, 1]
    empty = clusters.fit_all(df.limit(0), COLUMNS, [(2, 0)])
    assert len(empty[0].centres) == 0 and empty[0].cost == 0


def test_an_empty_cluster_stays_where_it_is(points):
    df, rows = points
    far = np.vstack([rows[:2], [[1e3, 1e3, 1e3]]])
    run = clusters.settle(df, COLUMNS, {0: far})[0]
    assert run.sizes[2] == 0 and np.array_equal(run.centres[2], far[2])
