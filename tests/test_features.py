from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.functions.numeric import chi2_tail, half_up
from conftest import customers, raw_frame


def by_id(df):
    return {r.customer_id: r for r in df.collect()}


def test_names():
    assert [X.snake_name(n) for n in ("customerID", "MonthlyCharges", "SeniorCitizen", "StreamingTV", "tenure")] == \
        ["customer_id", "monthly_charges", "senior_citizen", "streaming_tv", "tenure"]


def test_clean_types_and_imputation(raw_sample):
    df = X.clean(raw_sample)
    types = dict(df.dtypes)
    assert types["total_charges"] == "decimal(18,2)" and types["tenure"] == "int" and types["churn"] == "int"
    rows = by_id(df)
    assert rows["c4"].total_charges == 0
    assert sum(r.churn for r in rows.values()) == 2


def test_blank_total_stays_null_with_tenure(spark):
    df = X.clean(raw_frame(spark, [{"customerID": "x", "TotalCharges": " ", "tenure": "5"}]))
    assert df.first().total_charges is None


def test_service_counts(raw_sample):
    rows = by_id(X.build_features(raw_sample))
    assert (rows["c5"].n_addons, rows["c5"].n_services, rows["c5"].tenure_band) == (6, 9, "61m+")
    assert (rows["c4"].n_addons, rows["c4"].has_internet, rows["c4"].n_services) == (0, 0, 1)
    assert rows["c1"].n_services == 1
    assert [rows[c].has_protection_bundle for c in ("c2", "c3", "c5")] == [1, 0, 1]
    assert [rows[c].fiber_no_support for c in ("c2", "c3", "c5")] == [0, 1, 0]
    assert [rows[c].family for c in ("c1", "c2", "c5")] == [1, 0, 1]


def test_drift_is_zero_for_new_customers(raw_sample):
    rows = by_id(X.build_features(raw_sample))
    assert rows["c4"].charge_drift == 0
    assert abs(rows["c3"].charge_drift - (90 - 270.6 / 3)) < 1e-9


def test_auto_pay_and_contract(raw_sample):
    rows = by_id(X.build_features(raw_sample))
    assert {c: r.auto_pay for c, r in rows.items()} == {"c1": 0, "c2": 0, "c3": 0, "c4": 1, "c5": 1, "c6": 0}
    assert [rows[c].contract_months for c in ("c1", "c2", "c4")] == [1, 12, 24]


def test_unknown_contract_has_no_months(spark):
    df = X.build_features(raw_frame(spark, [{"customerID": "x", "Contract": "Three year"}]))
    assert df.first().contract_months is None


def test_bands_are_right_closed(spark):
    months = spark.createDataFrame([(m,) for m in (0, 6, 7, 12, 13, 24, 25, 48, 49, 60, 61, 500, -1)], "t int")
    got = [r.b for r in months.select(X.tenure_band(F.col("t")).alias("b")).collect()]
    labels = [label for label, _ in D.TENURE_BANDS]
    assert got == [labels[0], labels[0], labels[1], labels[1], labels[2], labels[2], labels[3], labels[3],
                   labels[4], labels[4], labels[5], labels[5], None]


def test_tiers_are_left_closed(spark):
    p = spark.createDataFrame([(x,) for x in (0.0, 0.19, 0.2, 0.45, 0.6, 1.0)], "p double")
    assert [r.t for r in p.select(X.risk_tier(F.col("p")).alias("t")).collect()] == \
        ["Low", "Low", "Medium", "High", "Critical", "Critical"]


def test_input_is_not_changed(raw_sample):
    base = X.clean(raw_sample)
    before = base.columns
    X.add_features(base)
    assert base.columns == before


def test_labels(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "p int, d int")
    assert [r.h for r in df.select(X.household(F.col("p"), F.col("d")).alias("h")).collect()] == \
        ["Partner + dependents", "Partner", "Dependents", "Single"]
    one = spark.createDataFrame([("Bank transfer (automatic)", "streaming_tv"), ("Mailed check", "online_backup")], "m string, s string")
    got = [tuple(r) for r in one.select(X.payment_short(F.col("m")), X.service_label(F.col("s"))).collect()]
    assert got == [("Bank transfer", "Streaming Tv"), ("Mailed check", "Online Backup")]


def test_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (-0.001,)], "x double")
    assert [r.v for r in df.select(half_up("x", 2).alias("v")).collect()] == [2.5, -2.5, 0.13, 0.0]
    assert [r.v for r in df.select(half_up("x", 0).alias("v")).collect()] == [3.0, -3.0, 0.0, 0.0]


def test_chi2_tail_against_known_quantiles():
    # 95 % quantiles of the chi-square distribution
    for dof, q in [(1, 3.841459), (2, 5.991465), (3, 7.814728), (4, 9.487729), (7, 14.067140)]:
        assert abs(chi2_tail(q, dof) - 0.05) < 1e-6


def test_sample_covers_all_situations():
    assert len(customers()) == 6


def test_half_up_leaves_large_values_alone(spark):
    from tenura.functions.numeric import chi2_tail, half_up

    row = spark.range(1).select(*[half_up(F.lit(v), 6).alias(f"v{i}") for i, v in enumerate([2e13, -7e18, 1e300, 0.0000005, -2.5])]).first()
    assert list(row) == [2e13, -7e18, 1e300, 0.000001, -2.5]
    assert 0 <= chi2_tail(2000.0, 800) < 1e-80 and abs(chi2_tail(3.841458820694124, 1) - 0.05) < 1e-12


def test_all_white_space_is_stripped_and_missing_labels_differ(spark):
    row = spark.createDataFrame([("\t\u00a0Yes \r\n",)], "Partner string")
    assert X.trim_strings(row).first()[0] == "Yes"
