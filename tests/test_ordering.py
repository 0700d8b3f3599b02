"""Order statistics against brute force: hot ties, remainders, fewer rows than parts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import ordering


def tie(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest() + ":" + str(key)


def hot_values(n, seed=1):
    """A third of all rows share one value."""
    rng = random.Random(seed)
    return [(f"k{i}", 5.0 if i % 3 == 0 else round(rng.uniform(0, 10), 2)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 203])
def test_ntile_matches_the_window(spark, n):
    rows = hot_values(n)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.q for r in ordering.ntile(df, "k", 4, "q", value="v").collect()}
    want, order = {}, sorted(rows, key=lambda r: (r[1], tie("tie", r[0])))
    sizes = [n // 4 + (1 if i < n % 4 else 0) for i in range(4)]
    at = 0
    for tile, size in enumerate(sizes, 1):
        for k, _ in order[at:at + size]:
            want[k] = tile
        at += size
    assert got == want


def test_ntile_by_label(spark):
    rows = [(f"k{i}", i % 7 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, g boolean")
    sizes = {(r.g, r.f): r["count"] for r in ordering.ntile(df, "k", 5, "f", by=["g"]).groupBy("g", "f").count().collect()}
    assert sizes == {**{(True, i): 3 for i in range(1, 6)}, **{(False, i): 17 for i in range(1, 6)}}


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, bounded, descending):
    rng = random.Random(3)
    rows = [(g, float(v), rng.randint(1, 9)) for g in ("a", "b") for v in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    out = ordering.running_totals(df, ["g"], "v", {"cum": "n"}, descending=descending, bounded=bounded, side=4)
    got = {(r.g, r.v): r.cum for r in out.collect()}
    for g in ("a", "b"):
        total = 0
        for _, v, n in sorted([r for r in rows if r[0] == g], key=lambda r: r[1], reverse=descending):
            total += n
            assert got[(g, v)] == total


def test_percentiles_match_numpy(spark):
    values = [v for _, v in hot_values(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    row = ordering.exact_percentiles(df, [], "v", [0.0, 0.1, 0.5, 0.9, 1.0], ["a", "b", "c", "d", "e"]).first()
    assert row.n == 500
    assert np.allclose([row.a, row.b, row.c, row.d, row.e], np.percentile(values, [0, 10, 50, 90, 100]))


def test_quantile_cut(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)] + [(None,)], "v double")
    got = [r.q for r in ordering.quantile_cut(df, "v", ["q1", "q2", "q3", "q4"], "q").orderBy(F.asc_nulls_last("v")).collect()]
    assert got == ["q1", "q1", "q2", "q2", "q3", "q3", "q4", "q4", None]


def test_hash_rank_is_a_permutation(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(300)], "k string")
    got = {r.k: r.r for r in ordering.hash_rank(df, "k", 9, "r").collect()}
    order = sorted(got, key=lambda k: tie(9, k))
    assert [got[k] for k in order] == list(range(1, 301))


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    a = {r.k for r in ordering.bounded_sample(df.repartition(3), 50, 0, "k").collect()}
    b = {r.k for r in ordering.bounded_sample(df.repartition(11), 50, 0, "k").collect()}
    assert a == b and len(a) == 50
    assert ordering.bounded_sample(df.limit(7), 50, 0, "k").count() == 7


def test_rank_cuts_with_many_cuts_on_one_value(spark):
    rows = [(f"k{i}", 1.0) for i in range(90)] + [(f"x{i}", 2.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("t", ordering.hash_order("s", "k"))
    ranks = spark.createDataFrame([(i, i * 10) for i in range(1, 11)], "cut_id int, rank long")
    got = {r.cut_id: (r.cut_value, r.cut_tie) for r in ordering.rank_cuts(df, [], "t", ranks, value="v").collect()}
    order = sorted(((v, tie("s", k)) for k, v in rows))
    assert got == {i: order[i * 10 - 1] for i in range(1, 11)}


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert ordering.ntile(df, "k", 4, "q", value="v").count() == 0
    assert ordering.hash_rank(df, "k", 1, "r").count() == 0


@pytest.mark.parametrize("partitions", ["2", "300"])
def test_number_of_buckets_changes_nothing(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        side = ordering.bucket_side(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert side == {"2": 4, "300": 25}[partitions]
    rows = [(v,) for v in range(500)]
    df = spark.createDataFrame(rows, "v long").withColumn("n", F.lit(1))
    got = {r.v: r.cum for r in ordering.running_totals(df, [], "v", {"cum": "n"}, side=side).collect()}
    assert got == {v: v + 1 for v in range(500)}


def sql_ntile(rows, tiles):
    """rows (key, group, value): tile per key, nulls first, ties in hash order."""
    out = {}
    for g in {r[1] for r in rows}:
        order = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0.0, tie("tie", r[0])))
        at = 0
        for tile in range(tiles):
            size = len(order) // tiles + (tile < len(order) % tiles)
            out.update({r[0]: tile + 1 for r in order[at:at + size]})
            at += size
    return out


def test_ntile_with_null_values_and_null_groups(spark):
    rng = random.Random(4)
    rows = [(f"k{i}", rng.choice([None, "a", "b"]), None if i % 4 == 0 else float(rng.randint(0, 9))) for i in range(160)]
    df = spark.createDataFrame(rows, "k string, g string, v double")
    got = {r.k: r.q for r in ordering.ntile(df, "k", 4, "q", value="v", by=["g"]).collect()}
    assert got == sql_ntile(rows, 4)
    flat = [(k, None, v) for k, _, v in rows]
    got = {r.k: r.q for r in ordering.ntile(df, "k", 4, "q", value="v").collect()}
    assert got == sql_ntile(flat, 4)
    folds = {(r.g, r.q): r["count"] for r in ordering.ntile(df, "k", 5, "q", by=["g"]).groupBy("g", "q").count().collect()}
    for g in (None, "a", "b"):
        n = sum(r[1] == g for r in rows)
        assert [folds[g, t] for t in range(1, 6)] == [n // 5 + (t <= n % 5) for t in range(1, 6)]


def test_ntile_of_six_thousand_groups(spark):
    df = spark.range(12_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 6000).alias("g"))
    sizes = ordering.ntile(df, "k", 4, "q", by=["g"]).groupBy("q").count().collect()
    assert {r.q: r["count"] for r in sizes} == {1: 6000, 2: 6000}


def test_running_totals_with_null_values_and_keys(spark):
    rows = [(g, v, 1) for g in (None, "a") for v in [None, *map(float, range(30))]]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    for bounded in (True, False):
        up = {(r.g, r.v): r.c for r in ordering.running_totals(df, ["g"], "v", {"c": "n"}, bounded=bounded).collect()}
        down = {(r.g, r.v): r.c for r in ordering.running_totals(df, ["g"], "v", {"c": "n"}, descending=True, bounded=bounded).collect()}
        assert len(up) == len(rows)
        for g in (None, "a"):
            assert up[g, None] == 1 and up[g, 0.0] == 2 and up[g, 29.0] == 31
            assert down[g, None] == 31 and down[g, 29.0] == 1


def test_ordinals_of_any_labels(spark):
    rng = random.Random(6)
    names = sorted({f"{rng.random()}" for _ in range(700)})
    df = spark.createDataFrame([(n,) for n in rng.sample(names, len(names))], "name string")
    assert [r.name for r in ordering.ordinals(df, "name", "i").orderBy("i").collect()] == names
    assert ordering.ordinals(df.limit(0), "name", "i").count() == 0
