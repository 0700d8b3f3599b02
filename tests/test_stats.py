import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tenura.operators import breakdowns, segments, stats
from tenura.functions import domain as D


def test_yates_on_two_by_two(spark):
    rows = [("a", 1)] * 10 + [("a", 0)] * 20 + [("b", 1)] * 15 + [("b", 0)] * 5
    df = spark.createDataFrame(rows, "f string, churn int")
    r = stats.cramers_v(df, ["f"]).first()
    n, a, b, c, d = 50, 10, 20, 15, 5
    chi2 = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert math.isclose(r.chi2, chi2) and r.dof == 1
    assert math.isclose(r.cramers_v, math.sqrt(chi2 / n))
    assert math.isclose(r.p_value, math.erfc(math.sqrt(chi2 / 2)))


def test_larger_table_with_an_empty_cell(spark):
    rows = [("a", 1)] * 10 + [("b", 0)] * 20 + [("c", 1)] * 5 + [("c", 0)] * 5
    r = stats.cramers_v(spark.createDataFrame(rows, "f string, churn int"), ["f"]).first()
    observed = np.array([[10, 0], [0, 20], [5, 5]])
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / observed.sum()
    chi2 = ((observed - expected) ** 2 / expected).sum()
    assert math.isclose(r.chi2, chi2) and r.dof == 2 and math.isclose(r.p_value, math.exp(-chi2 / 2))


def test_one_level_only(spark):
    r = stats.cramers_v(spark.createDataFrame([("a", 1), ("a", 0)], "f string, churn int"), ["f"], with_p=False).first()
    assert r.cramers_v is None


def test_mann_whitney_counts_pairs(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(2), float(rng.randrange(12))) for _ in range(200)]
    r = stats.mann_whitney(spark.createDataFrame(rows, "churn int, v double"), ["v"]).first()
    a, b = [v for c, v in rows if c], [v for c, v in rows if not c]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r.u == u and math.isclose(r.rank_biserial, 1 - 2 * u / (len(a) * len(b)))
    assert r.median_churned == np.median(a) and r.median_retained == np.median(b)
    assert 0 <= r.p_value <= 1


def test_spearman_matches_pandas(spark):
    rng = random.Random(12)
    pdf = pd.DataFrame({"a": [rng.randrange(5) for _ in range(150)], "b": [rng.random() for _ in range(150)]})
    pdf["c"] = pdf["a"] * 2 - pdf["b"]
    got = {(r.x, r.y): r.rho for r in stats.spearman_matrix(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    want = pdf.rank().corr()
    assert len(got) == 9 and all(abs(got[(x, y)] - want.loc[x, y]) < 1e-9 for x, y in got)


def test_numeric_summary(spark):
    values = [1.5, 2.0, 2.0, 9.25, -3.0]
    r = breakdowns.numeric_summary(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"], r["p50"]) == (5, 2.35, -3.0, 9.25, 2.0)
    assert r["std"] == round(np.std(values, ddof=1), 2)


def test_breakdown_shows_empty_levels(spark):
    df = spark.createDataFrame([("One year", 1, 10.0, 5)], "contract_type string, churn int, monthly_charges double, tenure int") \
        .withColumn("monthly_charges", F.col("monthly_charges").cast("decimal(18,2)")) \
        .withColumns({c: F.lit("x") for c in ("internet_service", "payment_method", "tenure_band")})
    rows = {(r.field, r.level): r for r in breakdowns.dimension_breakdown(df).collect()}
    assert len(rows) == 16
    assert rows[("contract_type", "One year")].customers == 1 and rows[("contract_type", "Two year")].churn_rate == 0


def test_names_are_made_unique(spark):
    base = {c: 1.0 for c in D.SEGMENT_FEATURES}
    rows = [(0, 5, 0.1, {**base, "auto_pay": 1.0}), (1, 5, 0.1, {**base, "auto_pay": 0.0}), (2, 5, 0.1, {**base, "auto_pay": 0.0})]
    profile = spark.createDataFrame([(i, n, r, *m.values()) for i, n, r, m in rows],
                                    ["segment_id", "customers", "churn_rate", *D.SEGMENT_FEATURES])
    named = profile.withColumn("segment_name", F.lit("same"))
    got = {r.segment_id: r.segment_name for r in segments.disambiguate_names(named).collect()}
    assert got == {0: "same, auto-pay", 1: "same, manual pay #1", 2: "same, manual pay #2"}


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 2.0, 3, 0, 12, 0, 1), (5, 4.0, 3, 1, 1, 1, 1)], D.SEGMENT_FEATURES)
    rows = segments.segment_features(df).collect()
    assert [r.z_n_services for r in rows] == [0, 0] and [round(r.z_tenure, 9) for r in rows] == [-1, 1]


def test_spearman_of_odd_columns(spark):
    """Nulls by pair, a column of nulls, a constant, many and few values, an empty table."""
    rng = random.Random(7)
    rows = [(None if i % 7 == 0 else rng.gauss(0, 1), rng.randint(0, 3), None if i % 5 == 0 else rng.randint(0, 400), None, 1.0)
            for i in range(1500)]
    schema = "a double, b int, c int, nothing double, same double"
    names = ["a", "b", "c", "nothing", "same"]
    got = {(r.x, r.y): r.rho for r in stats.spearman_matrix(spark.createDataFrame(rows, schema), names).collect()}
    assert set(got) == {(x, y) for x in names for y in names}
    ranks = pd.DataFrame(rows, columns=names, dtype=float).rank()
    for x in "abc":
        for y in "abc":
            assert abs(got[x, y] - ranks[x].corr(ranks[y])) < 1e-9
    assert got["a", "nothing"] is None and got["nothing", "nothing"] is None
    assert got["a", "same"] is None and got["same", "same"] is None
    none = stats.spearman_matrix(spark.createDataFrame([], schema), names).collect()
    assert len(none) == 25 and all(r.rho is None for r in none)
