"""Exact order statistics without one-task windows.

Three ideas carry everything here:
* count rows per distinct value first, so ties (however hot) shrink on the map side;
* split the ordered values into buckets, total the buckets, and run the window inside each bucket;
* break ties by md5 of the key, whose hex prefix spreads any group of rows evenly.

The plan is the same for every table size. Nulls are ordered like the smallest value: first ascending,
last descending. A null group is a group. Tables of cut rows and totals never pass through the driver.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tenura.session import written_table

PREFIX_CHARS = 4            # 16**4 = 65,536 hash buckets inside one tied value


def bucket_side(spark: SparkSession) -> int:
    """Value buckets are side x side. About two for each shuffle partition: the setting that says into how
    many tasks the data is to be cut, so buckets stay as small as any other task's rows. It moves work
    between tasks and never changes a result."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(4, min(64, round((2 * partitions) ** 0.5 + 0.499)))


def join_same(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null equals null. Keeps the columns of the left and the other ones of the right."""
    right = right.withColumnsRenamed({c: f"_same_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in on])
    return left.join(right, same, how).drop(*[f"_same_{c}" for c in on])


def _side(df: DataFrame, by: list[str]) -> DataFrame:
    """A table with a few rows per group, as the side of a join. Without groups its size is known and it is
    broadcast. With groups their number decides: it is written, and Catalyst chooses by its real size."""
    return written_table(df.sparkSession, df) if by else F.broadcast(df)


def hash_order(seed, key: Column | str) -> Column:
    """A reproducible "random" order: md5 of seed and key, the key itself behind it for uniqueness."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), k)), F.lit(":"), k)


def value_aggregate(df: DataFrame, keys: list[str], value: str, **sums: Column) -> DataFrame:
    """Rows per distinct value (column n) plus further sums: the small table windows run over."""
    return df.groupBy(*keys, value).agg(
        F.count("*").alias("n"), *[e.alias(name) for name, e in sums.items()])


def _bucket(cuts: str, value: Column, side: int) -> tuple[Column, Column]:
    """How many of the side * side - 1 sorted cut points lie below the value: a coarse step over
    every side-th cut, then a fine step inside it. Plain comparisons, so it stays in codegen."""
    def below(position):
        return (F.col(cuts)[position] < value).cast("int")

    coarse, fine = F.lit(0), F.lit(0)
    for i in range(1, side):
        coarse = coarse + below(F.lit(side * i - 1))
    for j in range(side - 1):
        fine = fine + below(F.col("_coarse") * side + j)
    return coarse, fine


def running_totals(df: DataFrame, keys: list[str], order: str, sums: dict[str, str],
                   descending: bool = False, bounded: bool = False, side: int | None = None) -> DataFrame:
    """Running sums (row included) over rows with distinct `order` values, per `keys`.

    bounded=True: the distinct values are few by construction (labels, whole months, probabilities rounded
    to five digits), so one window per key is enough. Callers round or check, they don't assume.

    Otherwise the values are cut into side * side ranges of about equal row count (see `bucket_side`).
    Bucket totals give each bucket its starting amount, and the window runs inside a bucket. df is read
    three times: pass a written table.
    """
    direction = F.desc if descending else F.asc
    if bounded:
        w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        w = w.orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({new: F.sum(c).over(w) for new, c in sums.items()})

    side = side or bucket_side(df.sparkSession)
    by = [*keys, "_all"]
    amounts = sorted(set(sums.values()))
    rows = df.withColumn("_all", F.lit(0))
    grid = F.array(*[F.lit(i / side ** 2) for i in range(1, side ** 2)])
    cuts = rows.groupBy(*by).agg(
        F.percentile_approx(F.col(order).cast("double"), grid, F.lit(20 * side ** 2)).alias("_cuts"))
    coarse, fine = _bucket("_cuts", F.col(order).cast("double"), side)
    # a null value lies before the first bucket
    rows = join_same(rows, _side(cuts, keys), by).withColumn("_coarse", coarse) \
        .withColumn("_bucket", F.coalesce(F.col("_coarse") * side + fine, F.lit(-1)))
    totals = rows.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in amounts])
    before = Window.partitionBy(*by).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "_bucket", *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_s_{c}") for c in amounts])
    inside = Window.partitionBy(*by, "_bucket").orderBy(direction(order)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = join_same(rows, _side(starts, keys), [*by, "_bucket"])
    return joined.withColumns(
        {new: F.sum(c).over(inside) + F.col(f"_s_{c}") for new, c in sums.items()}
    ).select(*df.columns, *sums)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                      names: list[str] | None = None, bounded: bool = False) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per key, plus the row count n.

    `keys` are feature or class labels. Nulls are left out.
    """
    names = names or [f"p{round(100 * p)}" for p in probs]
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counts = value_aggregate(rows, keys, "_v")
    if not bounded:
        counts = written_table(df.sparkSession, counts)
    ranked = running_totals(counts, keys, "_v", {"_upto": "n"}, bounded=bounded) \
        .withColumn("_all", F.lit(0))
    totals = counts.withColumn("_all", F.lit(0)).groupBy(*keys, "_all").agg(F.sum("n").alias("_rows"))
    ranked = join_same(ranked, _side(totals, keys), [*keys, "_all"])

    def at(rank: Column) -> Column:                 # value of the 0-based rank
        return F.min(F.when(F.col("_upto") > rank, F.col("_v")))

    aggs = []
    for p, name in zip(probs, names):
        pos = F.lit(p) * (F.col("_rows") - 1)
        aggs += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}"),
                 F.max(pos - F.floor(pos)).alias(f"_w_{name}")]
    table = ranked.groupBy(*keys).agg(F.max("_rows").alias("n"), *aggs)
    return table.select(*keys, "n", *[
        (F.col(f"_lo_{x}") + (F.col(f"_hi_{x}") - F.col(f"_lo_{x}")) * F.col(f"_w_{x}")).alias(x)
        for x in names])


def quantile_cut(df: DataFrame, value: str, labels: list[str], out: str) -> DataFrame:
    """Label equal-count ranges of a column: right-closed, lowest value included."""
    k = len(labels)
    edges = exact_percentiles(df, [], value, [i / k for i in range(1, k)],
                              [f"e{i}" for i in range(1, k)])
    cut = edges.select(F.array(*[f"e{i}" for i in range(1, k)])).scalar()
    v = F.col(value).cast("double")
    tagged = df.withColumn("_edges", cut)
    label = F.when(v.isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(labels[:-1]):
        label = label.when(v <= F.col("_edges")[i], F.lit(name))
    return tagged.withColumn(out, label.otherwise(F.lit(labels[-1]))).drop("_edges")


def rank_cuts(df: DataFrame, by: list[str], tie: str, ranks: DataFrame,
              value: str | None = None, descending: bool = False, bounded: bool = False) -> DataFrame:
    """Where does row number `rank` fall when each group is ordered by (value, tie)?

    df has columns by, tie (a hash_order string) and optionally value; ranks has by, cut_id, rank.
    Returns by, cut_id, cut_value, cut_tie: exactly `rank` rows of the group are at or before
    (cut_value, cut_tie). No row of df is shuffled except the members of one hash bucket per cut: value
    counts find the tied value, hash-prefix counts find the bucket in it. There may be any number of
    groups; rows meet the cuts in joins and nothing is collected.
    """
    v = value or "_one"
    rows = (df if value else df.withColumn("_one", F.lit(0))).select(*by, v, tie) \
        .withColumns({"_all": F.lit(0), "_prefix": F.substring(tie, 1, PREFIX_CHARS)})
    by_all = [*by, "_all"]
    ranks = ranks.withColumn("_all", F.lit(0))
    if value:
        counts = value_aggregate(rows, by_all, v)
        if not bounded:
            counts = written_table(df.sparkSession, counts)
        upto = running_totals(counts, by, v, {"_upto": "n"}, descending=descending, bounded=bounded)
        wanted = join_same(upto, _side(ranks, by), by_all) \
            .where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("n"))) \
            .select(*by_all, "cut_id", v, (F.col("rank") - (F.col("_upto") - F.col("n"))).alias("rank"))
    else:
        wanted = ranks.withColumn("_one", F.lit(0))
    wanted = _side(wanted, by)

    # Several cuts may fall on one tied value, so rows meet the distinct values only.
    at = [*by_all, v]
    buckets = join_same(rows, _hint(wanted.select(*at).distinct(), by), at) \
        .groupBy(*at, "_prefix").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*at).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = join_same(buckets.withColumn("_upto", F.sum("n").over(upto)), wanted, at) \
        .where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("n"))) \
        .select(*at, "cut_id", "_prefix", (F.col("rank") - (F.col("_upto") - F.col("n"))).alias("_within"))
    hit = _side(hit, by)
    member = Window.partitionBy(*at, "_prefix").orderBy(tie)
    near = join_same(rows, _hint(hit.select(*at, "_prefix").distinct(), by), [*at, "_prefix"]) \
        .withColumn("_within", F.row_number().over(member).cast("bigint"))
    return join_same(near, hit, [*at, "_prefix", "_within"]) \
        .select(*by, "cut_id", F.col(v).alias("cut_value"), F.col(tie).alias("cut_tie"))


def _hint(df: DataFrame, by: list[str]) -> DataFrame:
    return df if by else F.broadcast(df)


def ntile_ranks(df: DataFrame, by: list[str], tiles: int) -> DataFrame:
    """Last row number of every tile but the last: the first n mod tiles tiles get one row more."""
    sizes = df.withColumn("_all", F.lit(0)).groupBy(*by, "_all").agg(F.count("*").alias("_n"))
    return sizes.select(*by, "_n", F.explode(F.sequence(F.lit(1), F.lit(tiles - 1))).alias("cut_id")) \
        .select(*by, "cut_id", (F.col("cut_id") * F.floor(F.col("_n") / tiles)
                                + F.least(F.col("cut_id"), F.col("_n") % tiles)).alias("rank")) \
        .where(F.col("rank") > 0)


def ntile(df: DataFrame, key: str, tiles: int, out: str, value: str | None = None,
          by: list[str] = (), seed="tie") -> DataFrame:
    """Ntile over the whole base (or per small label group), ties in hash order of the key.

    The result is a projection: each row is compared with the (tiles - 1) cut rows. With fewer rows
    than tiles some leading cuts coincide, as in SQL.
    """
    by = list(by)
    rows = df.withColumn("_tie", hash_order(seed, key))
    cuts = rank_cuts(rows, by, "_tie", ntile_ranks(df, by, tiles), value=value)
    cuts = cuts.withColumn("_all", F.lit(0)).groupBy(*by, "_all").agg(          # at most tiles - 1 structs
        F.array_sort(F.collect_list(F.struct("cut_value", "cut_tie"))).alias("_cuts"))
    here = F.struct((F.col(value) if value else F.lit(0)).alias("cut_value"),
                    F.col("_tie").alias("cut_tie"))
    return join_same(rows.withColumn("_all", F.lit(0)), _side(cuts, by), [*by, "_all"], "left") \
        .withColumn(out, F.lit(1) + F.coalesce(
            F.size(F.filter("_cuts", lambda c: c < here)), F.lit(0))) \
        .drop("_tie", "_cuts", "_all")


def hash_rank(df: DataFrame, key: str, seed, out: str, by: list[str] = ()) -> DataFrame:
    """Row number 1..n in hash order. Rows are shuffled once, by hash prefix; the offsets table has
    at most 65,536 rows per group of `by` labels."""
    by = list(by)
    rows = df.withColumn("_tie", hash_order(seed, key)) \
        .withColumn("_prefix", F.substring("_tie", 1, PREFIX_CHARS))
    counts = rows.groupBy(*by, "_prefix").agg(F.count("*").alias("_n"))
    before = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))) \
        .orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_prefix").orderBy("_tie")
    return join_same(rows, _side(starts, by), [*by, "_prefix"]) \
        .withColumn(out, F.row_number().over(inside) + F.col("_start")) \
        .drop("_tie", "_prefix", "_start")


def ordinals(df: DataFrame, order: str, out: str) -> DataFrame:
    """Row number 1..n in order of a column of any orderable type, for rows with distinct values.

    Rows are dealt to ranges and written once; counts per range give each its start.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    ranges = written_table(spark, ranges)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))         # one row per range
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(order)
    return ranges.join(F.broadcast(starts), "_range").withColumn(
        out, (F.row_number().over(inside) + F.col("_start")).cast("int")).drop("_range", "_start")


def bounded_sample(df: DataFrame, n: int, seed, key: str) -> DataFrame:
    """At most n rows, the same ones however the data is partitioned (a sampling operator).

    Counts per hash prefix (at most 65,536) tell up to which prefix n rows lie; only rows up to there, about
    n in all, are sorted.
    """
    rows = df.withColumn("_tie", hash_order(seed, key)).withColumn("_prefix", F.substring("_tie", 1, PREFIX_CHARS))
    upto = Window.partitionBy(F.lit(0)).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = rows.groupBy("_prefix").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    last = counts.agg(F.min(F.when(F.col("_upto") >= n, F.col("_prefix")))).scalar()
    return rows.where(F.coalesce(F.col("_prefix") <= last, F.lit(True)) | F.col("_prefix").isNull()) \
        .orderBy("_tie").limit(n).drop("_tie", "_prefix")


def top_k(df: DataFrame, k: int, score: Column, key: str) -> DataFrame:
    """The k rows with the highest score; each task keeps k candidates only."""
    return df.orderBy(score.desc(), F.col(key)).limit(k)
