"""Stratified train/valid/test split and folds, reproducible on any partitioning."""

from pyspark.sql import DataFrame, Window, functions as F

from tenura.functions.domain import SplitSizes
from tenura.operators.ordering import hash_order, join_same, ntile, rank_cuts
from tenura.session import written_table


def split_quotas(df: DataFrame, label: str, sizes: SplitSizes) -> DataFrame:
    """Rows per label that go to test and to valid: (label, n, test_rows, valid_rows).

    Overall sizes are ceil(test * n) and ceil(valid / (1 - test) * rest); each is shared over the
    labels by largest remainder (ties: smaller label first). The windows run over one row per label.
    """
    one = Window.partitionBy(F.lit(0))
    counts = df.groupBy(label).agg(F.count("*").alias("n"))

    def share(frame, rows, total, out):
        """Largest-remainder share of `total` in proportion to `rows`."""
        exact = F.col(total).cast("double") * F.col(rows) / F.sum(rows).over(one)
        frame = frame.withColumns({"_floor": F.floor(exact), "_rest": exact - F.floor(exact)})
        order = Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), F.asc(label))
        extra = F.col(total) - F.sum("_floor").over(one)
        return frame.withColumn(out, F.col("_floor") + (F.row_number().over(order) <= extra).cast("int")) \
            .drop("_floor", "_rest")

    def part(total, fraction):
        # parts are given to six digits; the small step back keeps 0.1875 * 16 from becoming 4
        return F.ceil(total * F.lit(fraction) - 1e-9)

    counts = counts.withColumn("_test", part(F.sum("n").over(one), sizes.test))
    counts = share(counts, "n", "_test", "test_rows")
    counts = counts.withColumn("_left", F.col("n") - F.col("test_rows"))
    counts = counts.withColumn("_valid", part(F.sum("_left").over(one), sizes.valid / (1 - sizes.test)))
    counts = share(counts, "_left", "_valid", "valid_rows")
    return counts.select(label, "n", "test_rows", "valid_rows")


def split_cuts(df: DataFrame, key: str, label: str, sizes: SplitSizes) -> DataFrame:
    """Per label the last hash-order value of test and of test + valid (a table of two rows)."""
    quotas = split_quotas(df, label, sizes)
    ranks = quotas.select(label, F.explode(F.array(
        F.struct(F.lit(1).alias("cut_id"), F.col("test_rows").alias("rank")),
        F.struct(F.lit(2).alias("cut_id"), (F.col("test_rows") + F.col("valid_rows")).alias("rank")),
    )).alias("c")).select(label, "c.cut_id", "c.rank")
    rows = df.select(label, hash_order(sizes.seed, key).alias("_tie"))
    cuts = rank_cuts(rows, [label], "_tie", ranks.where(F.col("rank") > 0))
    return join_same(quotas.select(label), cuts, [label], "left").groupBy(label).agg(
        F.max(F.when(F.col("cut_id") == 1, F.col("cut_tie"))).alias("test_end"),
        F.max(F.when(F.col("cut_id") == 2, F.col("cut_tie"))).alias("valid_end"))


def assign_split(df: DataFrame, key: str, label: str, cuts: DataFrame, sizes: SplitSizes) -> DataFrame:
    """Adds the split column: a projection against two cut values per label. `cuts` comes from a written
    table, so Catalyst broadcasts it by its size. Customers without a label are a stratum of their own."""
    order = hash_order(sizes.seed, key)
    return join_same(df, cuts, [label]).withColumn(
        "split", F.when(order <= F.col("test_end"), "test")
        .when(order <= F.col("valid_end"), "valid").otherwise("train")).drop("test_end", "valid_end")


def stratified_split(df: DataFrame, key: str = "customer_id", label: str = "churn",
                     sizes: SplitSizes = SplitSizes()) -> DataFrame:
    return assign_split(df, key, label, written_table(df.sparkSession, split_cuts(df, key, label, sizes)), sizes)


def split_assignment(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Which split each customer landed in, as one long table of three id lists."""
    parts = [df.where(F.col("split") == s).select(key, F.lit(s).alias("split"))
             for s in ("train", "valid", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stratified_folds(df: DataFrame, key: str = "customer_id", label: str = "churn", folds: int = 5,
                     seed=42) -> DataFrame:
    """Fold 0..k-1: equal consecutive parts of each label's hash order."""
    tiled = ntile(df, key, folds, "fold", by=[label], seed=f"fold{seed}")
    return tiled.withColumn("fold", F.col("fold") - 1)
