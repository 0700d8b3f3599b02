import random

import pytest
from pyspark.sql import functions as F

from tenura.operators import evaluate as E
from tenura.operators import model_tables, models, segments
from tenura.functions import domain as D

TOY = models.Inputs(["contract", "fiber"], ["tenure", "charge"])
QUICK = models.ModelSettings(forest_trees=20, boost_iterations=10, net_hidden=(8,), net_iterations=60, forest_depth=5)


@pytest.fixture(scope="module")
def toy(spark):
    rng = random.Random(0)
    rows = []
    for i in range(600):
        contract, fiber = rng.choice(["m2m", "1y", "2y"]), rng.choice(["yes", "no"])
        tenure, charge = float(rng.randrange(72)), rng.gauss(65, 20)
        logit = 1.5 * (contract == "m2m") - 0.04 * tenure + 0.8 * (fiber == "yes") - 0.5
        churn = int(rng.random() < 1 / (1 + 2.718281828 ** -logit))
        rows.append((f"k{i}", contract, fiber, tenure, charge, churn, "test" if i >= 400 else "train"))
    df = spark.createDataFrame(rows, "customer_id string, contract string, fiber string, tenure double, charge double, "
                                     "churn int, split string")
    return models.as_training(df, TOY).cache()


def auc(model, rows):
    scored = models.with_probability(model, rows).select(F.lit("m").alias("model_name"), F.col("churn").alias("y"), "p")
    return E.roc_auc(scored).first().roc_auc


@pytest.mark.parametrize("name", list(models.BUILDERS))
def test_models_learn_the_signal(toy, name, tmp_path):
    train, test = toy.where("split = 'train'"), toy.where("split = 'test'")
    model = models.fit(name, train, QUICK, TOY)
    assert auc(model, test) > 0.7
    if name == "logistic_regression":
        models.save_model(model, str(tmp_path / "m"))
        again = models.load_model(str(tmp_path / "m"))
        a = [r.p for r in models.with_probability(model, test).orderBy("customer_id").collect()]
        b = [r.p for r in models.with_probability(again, test).orderBy("customer_id").collect()]
        assert a == b and all(0 <= p <= 1 for p in a)
        table = models.logistic_coefficients(model, test.sparkSession, TOY).collect()
        assert {r.feature for r in table} == {"contract_1y", "contract_2y", "contract_m2m", "fiber_yes", "tenure", "charge"}


@pytest.mark.parametrize("name", list(models.BUILDERS))
def test_tables_score_like_the_model(toy, name, tmp_path):
    model = models.fit(name, toy.where("split = 'train'"), QUICK, TOY)
    own = model.transform(toy).select("customer_id", models.vector_to_array("probability")[1].alias("p"))
    both = own.join(model_tables.score_from_tables(name, model, toy), "customer_id").collect()
    assert len(both) == toy.count() and max(abs(r.p - r.p_table) for r in both) < 1e-9
    assert len({round(r.p_table, 6) for r in both}) > 20
    models.save_model(model, str(tmp_path / "m"))
    again = models.with_probability(models.load_model(str(tmp_path / "m")), toy).select("customer_id", F.col("p").alias("q"))
    assert again.join(models.with_probability(model, toy), "customer_id").where("p <> q").isEmpty()


def test_node_table_is_a_set_of_trees(toy):
    model = models.fit("random_forest", toy, QUICK, TOY)
    nodes = model_tables.node_table("random_forest", model, toy.sparkSession).cache()
    assert nodes.columns == model_tables.NODES and nodes.select("tree").distinct().count() == QUICK.forest_trees
    assert 0 < model_tables.levels_of(nodes) <= QUICK.forest_depth
    inner = nodes.where("feature IS NOT NULL")
    assert inner.where("(threshold IS NULL) = (left_values IS NULL)").isEmpty()
    reached = inner.selectExpr("tree", "explode(array(left, right)) node").groupBy("tree", "node").count()
    assert reached.where("count <> 1").isEmpty() and reached.count() == nodes.count() - QUICK.forest_trees
    assert nodes.where("feature IS NULL AND (value IS NULL OR left <> node OR right <> node)").isEmpty()


def test_unseen_level_becomes_zeros(toy):
    prepared = models.Pipeline(stages=models.feature_stages(toy, TOY)).fit(toy)
    odd = toy.limit(1).withColumn("contract", F.lit("5y")).withColumn("fiber", F.lit("yes"))
    vector = prepared.transform(odd).first().features.toArray()
    assert list(vector[:4]) == [0.0, 0.0, 0.0, 1.0] and len(vector) == 6


def test_codes(toy):
    vocabulary, moments = models.fit_codes(toy.where("contract <> '2y'"), ["contract", "fiber"], ["tenure"])
    rows = models.apply_codes(toy, vocabulary, moments, ["contract", "fiber"], ["tenure"]).collect()
    assert {(r.contract, r.code_contract) for r in rows} == {("1y", 1), ("m2m", 2), ("2y", 0)}
    assert {(r.fiber, r.code_fiber) for r in rows} == {("no", 1), ("yes", 2)}


def test_cross_validation(toy):
    folded = toy.where("split = 'train'").withColumn("fold", (F.crc32("customer_id") % 3).cast("int"))
    r = models.cross_validate(["logistic_regression"], folded, 3, QUICK, TOY).first()
    assert r.cv_auc_mean > 0.7 and 0 <= r.cv_auc_std < 0.2


def test_clusters_are_found_again(spark):
    rng = random.Random(1)
    rows = [(f"k{i}", *[10 * (i % 2) + rng.random() for _ in D.SEGMENT_FEATURES]) for i in range(60)]
    df = spark.createDataFrame(rows, ["customer_id", *D.SEGMENT_FEATURES])
    labelled = segments.segment_customers(df, k=2, starts=2)
    assert {(int(r.customer_id[1:]) % 2, r.segment_id) for r in labelled.collect()} == {(0, 0), (1, 1)}
    scan = {r.k: r for r in segments.scan_k(df, range(2, 4), starts=1).collect()}
    assert scan[2].silhouette > 0.9 and scan[3].inertia <= scan[2].inertia
    pcs = segments.segment_projection(labelled).collect()
    assert len({r.pc1 > 0 for r in pcs if r.segment_id == 1}) == 1


def test_rows_walk_the_trees_without_a_join_per_level(spark):
    """By hand: thresholds, lists of values, a tree that is one leaf, missing numbers, and a key that comes twice."""
    nodes = spark.createDataFrame([
        ("m", 0, 0, 0, 5.0, None, 1, 2, None), ("m", 0, 1, 1, None, [0.0, 2.0], 3, 4, None), ("m", 0, 2, None, None, None, 2, 2, 10.0),
        ("m", 0, 3, None, None, None, 3, 3, 1.0), ("m", 0, 4, None, None, None, 4, 4, 2.0), ("m", 2, 0, None, None, None, 0, 0, 0.5)],
        "model_name string, tree int, node int, feature int, threshold double, left_values array<double>, left int, right int, value double")
    rows = spark.createDataFrame([(1, [5.0, 0.0]), (2, [4.0, 1.0]), (3, [4.0, 2.0]), (4, [6.0, 2.0]), (5, [float("nan"), 0.0]),
                                  (6, None), (7, [1.0, 0.0]), (7, [9.0, 0.0]), (None, [0.0, 0.0])], "k int, x array<double>")
    assert model_tables.levels_of(nodes) == 2
    scored = model_tables.score_nodes(rows, nodes, "k")
    assert {r.k: r.score for r in scored.collect()} == {1: 1.5, 2: 2.5, 3: 1.5, 4: 10.5, 5: 10.5, 6: 10.5, 7: 12.0, None: 1.5}
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()
    assert model_tables.levels_of(nodes.where("tree = 2")) == 0
    with pytest.raises(Exception, match="the trees ask for 2"):
        model_tables.score_nodes(rows.selectExpr("k", "slice(x, 1, 1) x"), nodes, "k").collect()


def test_fits_use_as_many_tasks_as_cores_and_rows_ask_for(toy):
    spark = toy.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        cores = spark.sparkContext.defaultParallelism
        assert models.fit_tasks(toy) == -(-8 // cores) * cores
        assert models.fit_tasks(spark.range(1_000_001)) == -(-11 // cores) * cores
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert models.fit_tasks(toy) == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
