import random

import pytest
from pyspark.sql import functions as F

from tenura.functions.domain import Economics
from tenura.operators import evaluate as E
from tenura.operators import split


def scored(spark, y, p, charge=100.0, model="m"):
    rows = [(f"k{i}", model, int(a), round(float(b), 5), charge, "test") for i, (a, b) in enumerate(zip(y, p))]
    df = spark.createDataFrame(rows, "customer_id string, model_name string, y int, p double, monthly_charges double, split string")
    return df.withColumn("monthly_charges", F.col("monthly_charges").cast("decimal(18,2)"))


ECON = Economics(offer_cost=20, months_saved=10, success_rate=0.5)


def test_profit_by_hand(spark):
    df = scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.2, 0.1])
    assert E.expected_profit(df, 0.5, ECON).first().profit == 460
    assert E.expected_profit(df, 0.99, ECON).first().profit == 0


def test_curve_agrees_with_single_thresholds(spark):
    rng = random.Random(5)
    df = scored(spark, [rng.randrange(2) for _ in range(400)], [rng.random() for _ in range(400)])
    curve = {round(r.threshold, 2): r.profit for r in E.profit_curve(df, ECON).collect()}
    assert len(curve) == 86
    for t in (0.05, 0.29, 0.57, 0.9):
        assert abs(curve[t] - E.expected_profit(df, t, ECON).first().profit) < 1e-6


def test_threshold_lies_between_separated_groups(spark):
    rng = random.Random(2)
    y = [rng.randrange(2) for _ in range(1000)]
    p = [min(max((0.8 if v else 0.2) + rng.gauss(0, 0.01), 0), 1) for v in y]
    curve = E.profit_curve(scored(spark, y, p, 70.0), Economics(30, 6, 0.3))
    assert 0.2 < E.best_threshold(curve).first().threshold <= 0.8


def test_lowest_threshold_wins_ties(spark):
    curve = spark.createDataFrame([("m", 0.3, 5.0), ("m", 0.2, 5.0), ("m", 0.1, 1.0)], "model_name string, threshold double, profit double")
    assert E.best_threshold(curve).first().threshold == 0.2


def test_lift(spark):
    rng = random.Random(9)
    noise = scored(spark, [rng.randrange(2) for _ in range(5000)], [rng.random() for _ in range(5000)])
    assert abs(E.top_decile_lift(noise).first().top_decile_lift - 1) < 0.2
    perfect = scored(spark, [1] * 10 + [0] * 90, [0.9] * 10 + [0.1] * 90)
    assert E.top_decile_lift(perfect).first().top_decile_lift == 10
    assert E.top_decile_lift(scored(spark, [1, 0], [0.7, 0.2])).first().top_decile_lift == 2   # at least one row


def test_auc_counts_ties_half(spark):
    assert E.roc_auc(scored(spark, [1, 0], [0.5, 0.5])).first().roc_auc == 0.5
    assert E.roc_auc(scored(spark, [1, 0, 1, 0], [0.9, 0.1, 0.8, 0.2])).first().roc_auc == 1
    assert E.roc_auc(scored(spark, [1, 1], [0.4, 0.6])).first().roc_auc is None                # one class


def test_average_precision_by_hand(spark):
    ap = E.average_precision(scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.1])).first().pr_auc
    assert abs(ap - (0.5 * 1 + 0.5 * 2 / 3)) < 1e-12


def test_brier_and_confusion(spark):
    df = scored(spark, [1, 0], [0.9, 0.2])
    assert abs(E.brier_score(df).first().brier - (0.01 + 0.04) / 2) < 1e-12
    assert {r.cell: r.n for r in E.confusion_matrix(df).collect()} == {"TN": 1, "FP": 0, "FN": 0, "TP": 1}


def test_precision_is_zero_when_nobody_is_called(spark):
    r = E.threshold_metrics(scored(spark, [1, 0], [0.1, 0.2]), 0.9).first()
    assert (r.precision, r.recall, r.f1) == (0, 0, 0)


def test_gains_end_at_one(spark):
    rng = random.Random(4)
    df = scored(spark, [rng.randrange(2) for _ in range(37)], [round(rng.random(), 1) for _ in range(37)])
    rows = {r.step: r for r in E.cumulative_gains(df, 10).collect()}
    assert rows[10].share_reached == 1 and rows[10].contacted == 37 and rows[1].contacted == 3
    shares = [rows[i].share_reached for i in range(1, 11)]
    assert shares == sorted(shares)


def test_importance_finds_the_used_feature(spark):
    rng = random.Random(6)
    rows = [(f"k{i}", float(rng.random()), float(rng.random())) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id string, used double, unused double") \
        .withColumn("y", (F.col("used") > 0.5).cast("int"))
    imp = {r.feature: r for r in E.permutation_importance(
        df, ["used", "unused"], lambda d: d.withColumn("p", F.round("used", 5)), repeats=3).collect()}
    assert imp["used"].auc_drop > 0.3 and imp["unused"].auc_drop == 0


@pytest.mark.parametrize("n, churned", [(7043, 1869), (100, 1), (11, 5)])
def test_split_sizes(spark, n, churned):
    df = spark.range(n).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") < churned).cast("int").alias("churn"))
    counts = {r.split: (r.n, r.c) for r in split.stratified_split(df).groupBy("split").agg(
        F.count("*").alias("n"), F.sum("churn").alias("c")).collect()}
    test = -(-n // 5)
    valid = -(-(n - test) * 3 // 16)
    assert counts["test"][0] == test and counts["valid"][0] == valid
    assert sum(c[0] for c in counts.values()) == n
    if n == 7043:
        assert [counts[s][0] for s in ("train", "valid", "test")] == [4577, 1057, 1409]
        assert all(abs(c[1] / c[0] - churned / n) < 1e-3 for c in counts.values())


def test_folds_are_even(spark):
    df = spark.range(103).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 4 == 0).cast("int").alias("churn"))
    sizes = [r["count"] for r in split.stratified_folds(df).groupBy("fold", "churn").count().collect()]
    assert len(sizes) == 10 and set(sizes) <= {5, 6, 15, 16}


def test_top_share_inside_a_hot_tie(spark):
    """Half of all rows share one probability, so most cuts fall inside the tie."""
    import hashlib

    rows = [("m", f"k{i}", int(i % 3 == 0), 0.5 if i % 2 else round((i % 97) / 97, 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "model_name string, customer_id string, y int, p double")
    order = sorted(rows, key=lambda r: (-r[3], hashlib.md5(f"lift:{r[1]}".encode()).hexdigest() + ":" + r[1]))
    total = sum(r[2] for r in rows)
    got = {r.step: r for r in E.cumulative_gains(df, 50).collect()}
    for k in range(1, 51):
        n = 600 * k // 50
        assert got[k].contacted == n and got[k].share_reached == sum(r[2] for r in order[:n]) / total
    lift = E.top_decile_lift(df).first().top_decile_lift
    assert abs(lift - (sum(r[2] for r in order[:60]) / 60) / (total / 600)) < 1e-12


def test_unrounded_probabilities_are_rounded_in_the_counts(spark):
    df = spark.range(9000).select(F.lit("m").alias("model_name"), (F.col("id") % 2).cast("int").alias("y"), (F.lit(0.3) + F.col("id") * 1e-9).alias("p"))
    assert E.score_counts(df).count() == 2


def test_importance_sends_no_customers_through_the_driver(spark):
    """A ranked table that is small as a file is wide as rows: it meets the donors without a broadcast."""
    df = spark.range(300).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 3).cast("int").alias("y"),
                                 (F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    table = E.permutation_importance(df.withColumn("y", (F.col("y") == 0).cast("int")), ["a", "b"],
                                     lambda d: d.withColumn("p", F.round(F.col("b") / 5, 5)), repeats=2)
    text = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_rank" in text and not [x for x in text.splitlines() if "BroadcastHashJoin" in x and "_rank" in x]
    assert table.count() == 2


def test_importance_scores_equal_inputs_once_and_counts_every_test(spark):
    """Against a loop over all tests; values are null or tied."""
    import hashlib

    def md5(k):
        return hashlib.md5(f"42:{k}".encode()).hexdigest() + ":" + k

    rng = random.Random(3)
    rows = [(f"k{i}" if i % 10 else f"k{i + 1}", int(rng.random() < 0.4), rng.choice(["x", "z", None]), float(rng.randrange(5))) for i in range(90)]
    rows = sorted({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "customer_id string, y int, a string, b double")
    seen = spark.sparkContext.accumulator(0)

    def points(a, b):
        seen.add(1)
        return round((0.3 if a == "x" else 0.1) + b / 10, 5)

    score = F.udf(points, "double")
    got = {r.feature: r for r in E.permutation_importance(
        df, ["a", "b"], lambda d: d.withColumn("p", score("a", "b")), repeats=4).collect()}

    def auc(pairs):
        pos, neg = [p for y, p in pairs if y], [p for y, p in pairs if not y]
        return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)

    order, n = sorted(rows, key=lambda r: md5(r[0])), len(rows)
    scored = seen.value
    base = auc([(r[1], points(r[2], r[3])) for r in rows])
    for i, f in enumerate(["a", "b"]):
        drops = []
        for repeat in range(1, 5):
            step = 1 + E.shift_of(42, i, repeat) % (n - 1)
            mixed = [(r, order[(k + step) % n]) for k, r in enumerate(order)]
            drops.append(base - auc([(r[1], points(d[2], r[3]) if f == "a" else points(r[2], d[3])) for r, d in mixed]))
        assert abs(got[f].auc_drop - sum(drops) / 4) < 1e-12
    assert scored < n + 6 * n                                   # eight tests and the base would be 9 n


def test_importance_keeps_rows_with_null_or_repeated_keys(spark):
    """A row for each test whatever the keys are: the base's drop is 0 when the score ignores every input."""
    rows = [(None, 1, "x"), (None, 0, "y"), ("k", 1, None), ("k", 1, None), ("m", 0, "x")]
    df = spark.createDataFrame(rows, "customer_id string, y int, a string")
    seen = []

    def keep(d):
        seen.append(d)
        return d.withColumn("p", F.lit(0.5))

    one = E.permutation_importance(df, ["a"], keep, repeats=3).first()
    assert (one.auc_drop, one.std) == (0, 0)
    mixed = next(d for d in seen if "_tests" in d.columns)
    assert mixed.select(F.explode("_tests")).count() == 15
