"""Association statistics for many features at once, from counts per distinct value."""

from pyspark.sql import DataFrame, functions as F

from tenura.functions.numeric import chi2_p_value, normal_two_sided_p
from tenura.operators.ordering import running_totals
from tenura.session import written_table

EXACT = "decimal(38,0)"
FEW_VALUES = 128                # ranks of so many values are looked up in a map


def cramers_v(df: DataFrame, features: list[str], target: str = "churn", with_p: bool = True) -> DataFrame:
    """Cramer's V per feature. A 2 x 2 table gets the Yates correction, as in the usual chi2 test.

    One scan counts the cells of all features. The rest works on cells: for 2 x 2 tables all four
    |observed - expected| are equal, and sum(1 / expected) = N * sum(1 / row) * sum(1 / column).
    """
    tall = df.select(F.col(target).cast("string").alias("outcome"),
                     *[F.col(c).cast("string").alias(c) for c in features]) \
        .unpivot(["outcome"], features, "feature", "level") \
        .where(F.col("level").isNotNull() & F.col("outcome").isNotNull())
    cells = tall.groupBy("feature", "level", "outcome").agg(F.count("*").alias("o"))
    rows = cells.groupBy("feature", "level").agg(F.sum("o").alias("row_n"))
    cols = cells.groupBy("feature", "outcome").agg(F.sum("o").alias("col_n"))
    total = rows.groupBy("feature").agg(
        F.sum("row_n").alias("n"), F.count("*").alias("n_rows"), F.sum(1.0 / F.col("row_n")).alias("inv_rows"))
    col_side = cols.groupBy("feature").agg(F.count("*").alias("n_cols"), F.sum(1.0 / F.col("col_n")).alias("inv_cols"))
    joined = cells.join(rows, ["feature", "level"]).join(cols, ["feature", "outcome"]) \
        .join(total, "feature").join(col_side, "feature")
    n, o = F.col("n"), F.col("o")
    expected = F.col("row_n").cast("double") * F.col("col_n") / n
    sums = joined.groupBy("feature", "n", "n_rows", "n_cols", "inv_rows", "inv_cols").agg(
        F.sum(o.cast("double") * o / (F.col("row_n").cast("double") * F.col("col_n"))).alias("fit"),
        F.max(F.abs(o - expected)).alias("off"))
    two_by_two = (F.col("n_rows") == 2) & (F.col("n_cols") == 2)
    corrected = F.greatest(F.col("off") - 0.5, F.lit(0.0))
    chi2 = F.when(two_by_two, corrected * corrected * n * F.col("inv_rows") * F.col("inv_cols")) \
        .otherwise(F.greatest(n * (F.col("fit") - 1.0), F.lit(0.0)))
    smaller = F.least("n_rows", "n_cols") - 1
    out = sums.select(
        "feature", n.alias("n"), chi2.alias("chi2"),
        ((F.col("n_rows") - 1) * (F.col("n_cols") - 1)).cast("int").alias("dof"),
        F.sqrt(F.try_divide(chi2, (n * smaller).cast("double"))).alias("cramers_v"))
    return out.withColumn("p_value", chi2_p_value("chi2", "dof")) if with_p else out


def mann_whitney(df: DataFrame, features: list[str], target: str = "churn", with_p: bool = True) -> DataFrame:
    """Mann-Whitney U of the target = 1 rows per feature, medians and rank-biserial effect.

    Ranks come from counts per distinct value and bucketed running totals, so a continuous feature
    of any size needs no one-task sort. Rank and tie sums are exact decimals. The p-value is the
    two-sided normal approximation with tie and continuity correction.
    """
    tall = df.select(F.col(target).cast("int").alias("in_first"),
                     *[F.col(c).cast("double").alias(c) for c in features]) \
        .unpivot(["in_first"], features, "feature", "value") \
        .where(F.col("value").isNotNull() & F.col("in_first").isNotNull())
    counts = tall.groupBy("feature", "value").agg(
        F.count("*").alias("n"), F.sum(F.col("in_first").cast("bigint")).alias("n1"))
    counts = written_table(df.sparkSession, counts)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum("n1").alias("a"))
    ranked = running_totals(counts, ["feature"], "value", {"upto": "n", "upto1": "n1"}) \
        .join(F.broadcast(totals), "feature")                  # one row per feature named by the caller
    n, n1 = F.col("n").cast("decimal(18,0)"), F.col("n1").cast("decimal(18,0)")
    double_rank = (2 * (F.col("upto") - F.col("n")) + F.col("n") + 1).cast("decimal(18,0)")   # 2 x mean rank
    b_count, upto0 = F.col("rows") - F.col("a"), F.col("upto") - F.col("upto1")

    def median(upto, size):
        low = F.min(F.when(upto > F.floor((size - 1) / 2), F.col("value")))
        high = F.min(F.when(upto > F.ceil((size - 1) / 2), F.col("value")))
        return (low + high) / 2

    sums = ranked.groupBy("feature", "rows", "a").agg(
        F.sum((n1 * double_rank).cast(EXACT)).cast("double").alias("rank2"),
        F.sum((n * n * n - n).cast(EXACT)).cast("double").alias("ties"),
        median(F.col("upto1"), F.col("a")).alias("median_churned"),
        median(upto0, b_count).alias("median_retained"))
    a = F.col("a").cast("double")
    sums = sums.select("*", (F.col("rank2") / 2 - a * (a + 1) / 2).alias("u"),
                       (a * b_count.cast("double")).alias("pairs"), F.col("rows").cast("double").alias("all"))
    pairs, n_all = F.col("pairs"), F.col("all")
    deviation = F.sqrt(F.try_divide(pairs, F.lit(12.0)) * (
        n_all + 1 - F.try_divide(F.col("ties"), n_all * (n_all - 1))))
    larger = F.greatest(F.col("u"), pairs - F.col("u"))
    out = sums.select(
        "feature", "median_churned", "median_retained", F.col("u").alias("u"),
        (1.0 - F.try_divide(2.0 * F.col("u"), pairs)).alias("rank_biserial"),
        F.try_divide(larger - pairs / 2 - 0.5, deviation).alias("z"))
    return out.withColumn("p_value", normal_two_sided_p(F.greatest("z", F.lit(0.0)))) if with_p else out


def average_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, rank): the mean rank of every distinct value of every column."""
    tall = df.select([F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot([], columns, "feature", "value").where(F.col("value").isNotNull())
    counts = written_table(df.sparkSession, tall.groupBy("feature", "value").agg(F.count("*").alias("n")))
    ranked = running_totals(counts, ["feature"], "value", {"upto": "n"})
    return ranked.select("feature", "value", (F.col("upto") - (F.col("n") - 1) / 2).alias("rank"))


def spearman_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rank correlation of every pair of columns, long format (x, y, rho).

    Ranks of columns with few values are one map, looked up where the rows are read. All other columns meet their
    ranks in one join, a row per value, and come together again by row: two shuffles of rows however many columns
    there are, with AQE splitting hot values. The built-in correlation of ML buffers all rows of a tied value in
    one task, which a 0/1 column at scale does not survive.
    """
    spark = df.sparkSession
    numbered = written_table(spark, df.select(F.monotonically_increasing_id().alias("_row"),
                                              *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]))
    names = [f"_c{i}" for i in range(len(columns))]
    ranks = written_table(spark, average_ranks(numbered, names))
    sizes = {r["feature"]: r["n"] for r in ranks.groupBy("feature").agg(F.count("*").alias("n")).collect()}  # a row per column
    few = [c for c in names if 0 < sizes.get(c, 0) <= FEW_VALUES]
    many = [c for c in names if sizes.get(c, 0) > FEW_VALUES]
    looked_up = {c: F.lit(None).cast("double") for c in names}              # stays so for columns of nothing but nulls
    if few:
        maps = ranks.where(F.col("feature").isin(few)).agg(F.struct(*[
            F.map_from_entries(F.collect_list(F.when(F.col("feature") == c, F.struct("value", "rank")))).alias(c) for c in few])).scalar()
        looked_up |= {c: maps.getField(c)[F.col(c)] for c in few}
    wide = numbered.select("_row", *[e.alias(f"r{c}") for c, e in looked_up.items()])
    if many:
        tall = numbered.select("_row", F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in many])).alias("cell")) \
            .select("_row", "cell.*").where(F.col("value").isNotNull())
        met = tall.join(ranks, ["feature", "value"]).select("_row", *[
            F.when(F.col("feature") == c, F.col("rank")).alias(f"r{c}") for c in names])
        wide = wide.unionByName(met).groupBy("_row").agg(*[F.max(f"r{c}").alias(f"r{c}") for c in names])
    # One row per pair of columns goes into a partial aggregation by pair: a single correlation to compile, not one per pair.
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
                                for i in range(len(names)) for j in range(i, len(names))])).alias("pair")
    cells = wide.select(F.array(*[f"r{c}" for c in names]).alias("r"), pairs) \
        .select("pair.*", F.col("r")[F.col("pair.i")].alias("a"), F.col("r")[F.col("pair.j")].alias("b"))
    both_there = cells.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    rho = F.try_divide(F.covar_pop("a", "b"), F.stddev_pop("a") * F.stddev_pop("b"))       # null beside a constant column
    rho = written_table(spark, both_there.groupBy("i", "j").agg(rho.alias("rho")))         # a row per pair
    name = F.array(*[F.lit(c) for c in columns])
    both = F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))).alias("cell")
    # An empty table has every pair, too, without a correlation.
    return spark.range(1).select(pairs).select("pair.*").join(rho, ["i", "j"], "left").select("rho", both) \
        .select(name[F.col("cell.i")].alias("x"), name[F.col("cell.j")].alias("y"), "rho")
