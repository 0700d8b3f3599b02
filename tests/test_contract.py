import pytest

from tenura.functions import domain as D
from tenura.operators import contract
from conftest import customers, raw_frame


def changed(spark, i, **values):
    rows = customers()
    rows[i] = {**rows[i], **values}
    return raw_frame(spark, rows)


def test_sample_passes_with_a_warning(raw_sample):
    rep = contract.validate(raw_sample)
    assert rep.ok and rep.rows == 6
    assert any("TotalCharges" in w for w in rep.warnings)


def test_missing_column_is_fatal(raw_sample):
    with pytest.raises(contract.ContractError):
        contract.validate(raw_sample.drop("Contract"))
    rep = contract.validate(raw_sample.drop("Contract"), strict=False)
    assert rep.errors == ["Contract: required_columns (1)"] and not rep.warnings


def test_unknown_label(spark):
    bad = changed(spark, 0, Contract="Three year")
    rep = contract.validate(bad, strict=False)
    assert any(e.startswith("Contract") for e in rep.errors)
    assert [tuple(r) for r in contract.check_domains(bad).collect()] == [("Contract", "Three year", 1)]


def test_labels_are_trimmed_before_the_check(spark):
    assert contract.check_domains(changed(spark, 0, Contract=" One year ")).count() == 0


def test_repeated_key(spark):
    bad = changed(spark, 1, customerID="c1")
    assert contract.check_unique_key(bad, D.RAW_KEY).first().repeats == 1
    assert not contract.validate(bad, strict=False).ok


def test_blank_total_with_tenure_is_an_error(spark):
    rep = contract.validate(changed(spark, 1, TotalCharges=" "), strict=False)
    assert rep.errors == ["TotalCharges: numeric (2)"]


@pytest.mark.parametrize("text", ["5d", "nan", "", "1,5", "abc", "inf"])
def test_what_is_no_number(spark, text):
    got = {r.column_name: r.non_numeric for r in
           contract.check_numeric_parse(changed(spark, 0, MonthlyCharges=text)).collect()}
    assert got["MonthlyCharges"] == 1


def test_negative_beside_unparsable(spark):
    rows = customers()
    rows[0]["MonthlyCharges"], rows[1]["MonthlyCharges"] = "-1", "x"
    got = {r.column_name: r.negative for r in contract.check_non_negative(raw_frame(spark, rows)).collect()}
    assert got["MonthlyCharges"] == 1


def test_rate_limits(spark):
    everybody = raw_frame(spark, [{**c, "Churn": "Yes"} for c in customers()])
    assert contract.check_rate_drift(everybody).first().off
    assert contract.check_rate_drift(everybody.limit(0)).first().off


def test_empty_extract(raw_sample):
    rep = contract.validate(raw_sample.limit(0), strict=False)
    assert rep.ok and rep.rows == 0


def test_keys_and_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert [tuple(r) for r in contract.check_primary_key(parent, ["k"]).collect()] == [(2, 2)]
    assert [r.k for r in contract.check_foreign_key(child, "k", parent, "k").collect()] == [3]
    assert contract.check_value_in(child, "k", [1]).first().outside == 1
    assert {r.column_name: r.nulls for r in contract.check_not_null(child, ["k"]).collect()} == {"k": 1}


def test_reconcile(spark):
    a, b = spark.range(3).toDF("k"), spark.range(4).toDF("k")
    got = {r.table_name: (r.n, r.matches) for r in contract.reconcile_row_counts({"a": a, "b": b, "c": a}).collect()}
    assert got == {"a": (3, True), "b": (4, False), "c": (3, True)}


def test_missing_tables_and_lost_rows_are_errors(spark):
    with pytest.raises(contract.ContractError, match="is not given"):
        contract.check_relationship({})
    with pytest.raises(contract.ContractError, match="is not given"):
        contract.check_table_rules({})
    tables = {"extract": spark.range(5), "view": spark.range(4)}
    with pytest.raises(contract.ContractError, match="view: 4"):
        contract.reconcile(tables)
    contract.reconcile({"extract": spark.range(5), "view": spark.range(5)})


def test_relationships_are_counted_in_one_shuffle_of_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (7,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (3,), (3,), (4,)], "id bigint")
    pairs = [("c", "k", "p", "id", "one_to_one"), ("p", "id", "c", "k", "many_to_one"), ("none", "k", "p", "id", "many_to_one")]
    out = contract.check_relationship({"c": child, "p": parent, "none": child.where("k > 99")}, pairs)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.relationship, r.problem, r.n) for r in out.collect()) == [
        ("c.k -> p.id", "child_not_unique", 2), ("c.k -> p.id", "orphans", 2), ("c.k -> p.id", "parent_not_unique", 1),
        ("none.k -> p.id", "orphans", 0), ("none.k -> p.id", "parent_not_unique", 1),
        ("p.id -> c.k", "orphans", 1), ("p.id -> c.k", "parent_not_unique", 2)]
