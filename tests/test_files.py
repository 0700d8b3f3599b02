import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tenura.functions import domain as D
from tenura.functions import features as X
from tenura.operators import contract, star
from tenura.sources import files
from tenura.session import shared_folder


def write_text(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_blanks_stay_as_delivered(spark, tmp_path):
    path = write_text(tmp_path / "x.csv", ["a,b", "1, ", ",NULL"])
    assert [tuple(r) for r in files.read_raw_subscriptions(spark, path, ["a", "b"]).collect()] == [("1", " "), ("", "NULL")]


def test_swapped_header_fails(spark, tmp_path):
    path = write_text(tmp_path / "x.csv", ["b,a", "1,2"])
    with pytest.raises(Exception, match="CSV header"):
        files.read_raw_subscriptions(spark, path, ["a", "b"]).collect()


def test_raw_round_trip(spark, raw_sample, tmp_path):
    path = str(tmp_path / "raw")
    raw_sample.write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    back = files.read_raw_subscriptions(spark, path)
    assert back.columns == D.RAW_COLUMNS and contract.validate(back).ok
    assert files.table_fingerprint(back).first() == files.table_fingerprint(raw_sample).first()


def test_fingerprint_sees_content_not_order(spark):
    a = spark.createDataFrame([("x", 1), ("y", None)], "k string, v int")
    same, other = a.orderBy(F.desc("k")).select("v", "k"), a.withColumn("v", F.lit(1))
    assert files.table_fingerprint(a).first() == files.table_fingerprint(same).first()
    assert files.table_fingerprint(a).first() != files.table_fingerprint(other).first()


def test_scores_upsert(spark, tmp_path):
    path = str(tmp_path / "scores")
    both = spark.createDataFrame([("c", "a", 0.1), ("c", "b", 0.2)], "customer_id string, model_name string, p double")
    files.write_scores(both, path)
    files.write_scores(both.where("model_name = 'a'").withColumn("p", F.lit(0.9)), path)
    assert {(r.model_name, r.p) for r in spark.read.parquet(path).collect()} == {("a", 0.9), ("b", 0.2)}


def test_star_and_bi_round_trip(spark, raw_sample, tmp_path):
    f = X.build_features(raw_sample)
    dims = star.dim_contract(f), star.dim_payment(f), star.dim_internet(f)
    tables = {"dim_payment": dims[1], "dim_customer": star.dim_customer(f),
              "fact_subscription": star.fact_subscription(f, *dims), "dim_tenure_band": star.dim_tenure_band(spark)}
    folder = str(tmp_path / "star")
    files.write_star(tables, folder)
    files.write_star(tables, folder)                            # replaces, does not append
    assert files.read_table(spark, folder, "fact_subscription").count() == 6
    got = files.query(spark, "SELECT count(*) AS n FROM fact_subscription WHERE tenure >= :t",
                      {"fact_subscription": files.read_table(spark, folder, "fact_subscription")}, t=30)
    assert got.first().n == 2
    bi = str(tmp_path / "bi")
    files.export_bi(tables, bi)
    fact = files.read_bi_extract(spark, bi, "fact_subscription")
    assert dict(fact.dtypes)["monthly_charges"] == "decimal(18,2)" and fact.where("status = 'Churned'").count() == 2
    houses = {r.customer_id: r.household for r in files.read_bi_extract(spark, bi, "dim_customer").collect()}
    assert houses["c1"] == "Partner" and houses["c5"] == "Dependents"
    assert "Bank transfer" in {r.payment_short for r in files.read_bi_extract(spark, bi, "dim_payment").collect()}


def test_a_load_that_breaks_leaves_the_old_star(spark, tmp_path):
    folder = str(tmp_path / "star")
    names = ["a", "b", "c", "d", "e"]
    files.write_star({n: spark.createDataFrame([(1, n)], "v int, name string") for n in names}, folder)
    broken = {n: spark.createDataFrame([(2, n)], "v int, name string") for n in names}
    broken["d"] = broken["d"].withColumn("name", F.when(F.col("v") == 2, F.raise_error(F.lit("no disk"))).otherwise("d"))
    with pytest.raises(Exception, match="no disk"):
        files.write_star(broken, folder)                        # three tables are written, the fourth is not
    assert [(r.v, r.name) for n in names for r in files.read_table(spark, folder, n).collect()] == [(1, n) for n in names]
    assert files.star_commits(spark, folder).count() == 1


def test_a_star_can_be_built_from_the_one_it_replaces(spark, tmp_path):
    folder = str(tmp_path / "star")
    files.write_star({"t": spark.range(3), "gone": spark.range(1)}, folder)
    old = files.read_table(spark, folder, "t")
    files.write_star({"t": old.where("id > 0")}, folder)
    assert {r.id for r in files.read_table(spark, folder, "t").collect()} == {1, 2}
    assert old.count() == 3 and files.read_table(spark, folder, "t", number=1).count() == 3
    assert [(r.number, r.tables) for r in files.star_commits(spark, folder).orderBy("number").collect()] == [(1, ["gone", "t"]), (2, ["t"])]
    for name, number in (("gone", None), ("t", 3)):
        with pytest.raises(ValueError):
            files.read_table(spark, folder, name, number)
    with pytest.raises(ValueError):
        files.write_star({}, folder)


def test_a_folder_without_commits_is_read_as_it_is(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "plain" / "t"))
    assert files.read_table(spark, str(tmp_path / "plain"), "t").count() == 2
    with pytest.raises(AnalysisException):
        files.read_table(spark, str(tmp_path / "plain"), "other")


def test_insights_without_rows_are_skipped(spark, tmp_path):
    df = spark.range(2)
    assert files.write_insights({"a": df, "b": df.where("id > 5")}, str(tmp_path / "o")) == ["a"]


class FakeSession:
    """Stands for a cluster session: only what shared_folder reads."""

    def __init__(self, named, master="spark://head:7077"):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("hdfs://x/shared/")) == "hdfs://x/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession(None))


def test_fingerprint_tells_cells_and_nulls_apart(spark):
    def mark(rows):
        return files.table_fingerprint(spark.createDataFrame(rows, "a string, b string")).first().fingerprint

    marks = [mark([("a|b", "c")]), mark([("a", "b|c")]), mark([(None, "x")]), mark([("\\N", "x")]), mark([("-", "x")]), mark([("", "x")])]
    assert len(set(marks)) == len(marks)


def test_work_tables_are_cleared(spark, tmp_path):
    import os

    from tenura.session import clear_work, shared_folder, work_folder, written_table

    assert written_table(spark, spark.range(3)).count() == 3
    folder = os.path.dirname(work_folder(spark))
    assert any(n.startswith("work-") for n in os.listdir(folder)) and folder.startswith(shared_folder(spark))
    clear_work(spark)
    assert not any(n.startswith("work-") for n in os.listdir(folder))
