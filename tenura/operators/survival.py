"""Retention curves and the log-rank test, from counts per duration.

After the first group-by everything runs over the distinct durations. Whole months or days (an integer
column) are a few hundred per group however many customers there are, so one window each is enough; any
other type may have as many as there are customers and goes through value buckets.
"""

from pyspark.sql import DataFrame, functions as F

from tenura.functions.numeric import chi2_p_value
from tenura.operators.ordering import running_totals
from tenura.session import written_table

Z95 = 1.96


def _by_duration(df: DataFrame, by: list[str], duration: str, event: str) -> DataFrame:
    return df.groupBy(*by, F.col(duration).cast("double").alias("t")).agg(
        F.count("*").alias("n"), F.sum(F.col(event).cast("bigint")).alias("events"))


def _counted(df: DataFrame, duration: str, counts: DataFrame) -> tuple[DataFrame, bool]:
    """Counts per duration and whether one window per group can run over them."""
    whole = dict(df.dtypes)[duration] in ("tinyint", "smallint", "int", "bigint")
    return (counts if whole else written_table(df.sparkSession, counts)), whole


def km_by_group(df: DataFrame, group: list[str], duration: str = "tenure", event: str = "churn") -> DataFrame:
    """One Kaplan-Meier curve per group: t, at_risk, events, survival, ci_low, ci_high.

    Rows at event times only, plus an anchor (0, everybody, 0 events, 1, 1, 1) unless the first
    event is at 0. 95 % limits are Greenwood on the log-log scale; once nobody is left they equal
    the curve.
    """
    by = list(group)
    counts, whole = _counted(df, duration, _by_duration(df, by, duration, event))
    at_risk = running_totals(counts, by, "t", {"at_risk": "n"}, descending=True, bounded=whole)
    d, n = F.col("events"), F.col("at_risk")
    steps = at_risk.where(d > 0).select(
        *by, "t", "at_risk", "events",
        F.when(d < n, F.log1p(-d / n)).otherwise(0.0).alias("log_step"),
        F.when(d < n, d / (n.cast("double") * (n - d))).otherwise(0.0).alias("var_step"),
        (d == n).cast("int").alias("gone"))
    if not whole:
        steps = written_table(df.sparkSession, steps)
    steps = running_totals(steps, by, "t", {"log_s": "log_step", "var": "var_step", "ended": "gone"}, bounded=whole)
    spread = F.exp(Z95 * F.sqrt("var") / F.abs("log_s"))
    curve = steps.select(
        *by, "t", "at_risk", "events",
        F.when(F.col("ended") > 0, 0.0).otherwise(F.exp("log_s")).alias("survival"),
        F.when(F.col("ended") > 0, 0.0).otherwise(F.exp(F.col("log_s") * spread)).alias("ci_low"),
        F.when(F.col("ended") > 0, 0.0).otherwise(F.exp(F.col("log_s") / spread)).alias("ci_high"))
    return anchor(counts, by).unionByName(curve)


def anchor(counts: DataFrame, by: list[str]) -> DataFrame:
    """Start of the curve for groups without an event at 0."""
    first = F.min(F.when(F.col("events") > 0, F.col("t")))
    return counts.groupBy(*by).agg(F.sum("n").alias("at_risk"), first.alias("first")) \
        .where(F.coalesce(F.col("first") != 0, F.lit(True)) & F.col("at_risk").isNotNull()).select(
        *by, F.lit(0.0).alias("t"), "at_risk", F.lit(0).cast("bigint").alias("events"),
        *[F.lit(1.0).alias(c) for c in ("survival", "ci_low", "ci_high")])


def kaplan_meier(df: DataFrame, duration: str = "tenure", event: str = "churn") -> DataFrame:
    return km_by_group(df, [], duration, event)


def median_survival(curve: DataFrame, group: list[str] = ()) -> DataFrame:
    """First time at which at most half survive, null if never."""
    return curve.groupBy(*group).agg(F.min(F.when(F.col("survival") <= 0.5, F.col("t"))).alias("median"))


def retention_summary(df: DataFrame, group: str, horizons=(12, 24), duration: str = "tenure",
                      event: str = "churn") -> DataFrame:
    """Per group: size, share left after each horizon, median duration."""
    curve = km_by_group(df, [group], duration, event)
    return curve.groupBy(group).agg(
        F.max("at_risk").alias("customers"),
        *[F.max_by(F.when(F.col("t") <= h, F.col("survival")),
                   F.when(F.col("t") <= h, F.col("t"))).alias(f"s_{h}") for h in horizons],
        F.min(F.when(F.col("survival") <= 0.5, F.col("t"))).alias("median_months"))


def logrank_test(df: DataFrame, in_first: str, duration: str = "tenure", event: str = "churn",
                 with_p: bool = True) -> DataFrame:
    """Two-group log-rank test: one row with chi2 (1 degree of freedom) and its p-value.

    `in_first` is a 0/1 column naming the first group.
    """
    flag, e = F.col(in_first).cast("bigint"), F.col(event).cast("bigint")
    counts = df.groupBy(F.col(duration).cast("double").alias("t")).agg(
        F.count("*").alias("n"), F.sum(flag).alias("n1"), F.sum(e).alias("d"), F.sum(e * flag).alias("d1"))
    counts, whole = _counted(df, duration, counts)
    risk = running_totals(counts, [], "t", {"r": "n", "r1": "n1"}, descending=True, bounded=whole)
    r, d = F.col("r"), F.col("d")
    share = F.col("r1") / r
    one = risk.where(d > 0).agg(
        F.sum(F.col("d1") - d * share).alias("diff"),
        F.sum(F.when(r > 1, d * share * (1 - share) * (r - d) / (r - 1)).otherwise(0.0)).alias("var"))
    stat = one.select(F.try_divide(F.col("diff") * F.col("diff"), F.col("var")).alias("chi2"))
    return stat.withColumn("p_value", chi2_p_value("chi2", F.lit(1))) if with_p else stat
