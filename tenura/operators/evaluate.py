"""Ranking and threshold metrics of scored customers, and campaign economics.

Input rows: model_name, y (0/1), p, and for money questions monthly_charges. Probabilities are taken
with five digits (`score_counts` rounds them), so it has at most 100,001 rows per model and every curve,
area and threshold table is a small window over it. All models are measured in the same pass.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.functions.domain import Economics
from tenura.functions.numeric import half_up, ratio
from tenura.operators.ordering import PREFIX_CHARS, exact_percentiles, hash_order, hash_rank, running_totals
from tenura.session import written_table

P5 = "decimal(9,5)"
EXACT = "decimal(38,0)"


def score_counts(scored: DataFrame, keys: list[str] = ("model_name",)) -> DataFrame:
    """Per key and probability: customers n, positives pos, charges of the positives."""
    y = F.col("y").cast("bigint")
    lost = F.sum(F.when(F.col("y") == 1, F.col("monthly_charges"))) if "monthly_charges" in scored.columns \
        else F.lit(None).cast("decimal(28,2)")
    return scored.withColumn("p", half_up("p", 5)).groupBy(*keys, "p").agg(
        F.count("*").alias("n"), F.sum(y).alias("pos"), lost.alias("pos_charges"))


def auc_of_counts(counts: DataFrame, keys: list[str], out: str = "roc_auc") -> DataFrame:
    """Area under the ROC curve, ties counting half; null when one class is missing. Exact sums."""
    rows = counts.withColumn("neg", F.col("n") - F.col("pos"))
    below = running_totals(rows, keys, "p", {"neg_upto": "neg"}, bounded=True)
    half_pairs = F.sum((F.col("pos").cast("decimal(18,0)")
                        * (2 * F.col("neg_upto") - F.col("neg")).cast("decimal(18,0)")).cast(EXACT))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return below.groupBy(*keys).agg(F.try_divide(half_pairs.cast("double"), 2.0 * pairs).alias(out))


def roc_auc(scored: DataFrame, keys: list[str] = ("model_name",)) -> DataFrame:
    return auc_of_counts(score_counts(scored, keys), list(keys))


def _from_top(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Running customers (cum_n) and positives (tp) from the highest probability down, and totals."""
    cum = running_totals(counts, keys, "p", {"cum_n": "n", "tp": "pos"}, descending=True, bounded=True)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return cum.withColumns({"rows": F.sum("n").over(whole), "positives": F.sum("pos").over(whole)})


def ap_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    step = ratio(F.col("pos"), F.col("positives")) * ratio(F.col("tp"), F.col("cum_n"))
    return _from_top(counts, keys).groupBy(*keys).agg(F.sum(step).alias("pr_auc"))


def average_precision(scored: DataFrame, keys: list[str] = ("model_name",)) -> DataFrame:
    """Sum of recall steps times precision (not the trapezoid)."""
    return ap_of_counts(score_counts(scored, keys), list(keys))


def brier_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    p = F.col("p").cast(P5)
    n, pos = F.col("n").cast("decimal(18,0)"), F.col("pos").cast("decimal(18,0)")
    miss = (p * p).cast("decimal(12,10)") * (n - pos) + ((1 - p) * (1 - p)).cast("decimal(12,10)") * pos
    return counts.groupBy(*keys).agg(ratio(F.sum(miss.cast("decimal(38,10)")), F.sum("n")).alias("brier"))


def brier_score(scored: DataFrame, keys: list[str] = ("model_name",)) -> DataFrame:
    return brier_of_counts(score_counts(scored, keys), list(keys))


def threshold_of_counts(counts: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    hit = F.col("p") >= threshold
    sums = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("called"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.sum("pos").alias("positives"))
    return sums.select(
        *keys, F.lit(float(threshold)).alias("threshold"),
        F.coalesce(ratio(F.col("tp"), F.col("called")), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("positives")), F.lit(0.0)).alias("recall"),
        F.coalesce(ratio(2 * F.col("tp"), F.col("called") + F.col("positives")), F.lit(0.0)).alias("f1"))


def threshold_metrics(scored: DataFrame, threshold: float = 0.5, keys: list[str] = ("model_name",)) -> DataFrame:
    return threshold_of_counts(score_counts(scored, keys), list(keys), threshold)


def confusion_matrix(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Four cells per model, empty ones as 0."""
    called, y = F.col("p") >= threshold, F.col("y") == 1
    cells = scored.groupBy("model_name").agg(
        F.count_if(~y & ~called).alias("TN"), F.count_if(~y & called).alias("FP"),
        F.count_if(y & ~called).alias("FN"), F.count_if(y & called).alias("TP"))
    return cells.unpivot("model_name", ["TN", "FP", "FN", "TP"], "cell", "n")


def roc_points(scored: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) per distinct probability, from (0, 0) with no threshold."""
    keys = ["model_name"]
    top = _from_top(score_counts(scored, keys), keys)
    points = top.select(
        *keys, F.col("p").alias("threshold"),
        ratio(F.col("cum_n") - F.col("tp"), F.col("rows") - F.col("positives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"))
    start = scored.select(*keys).distinct().select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_points(scored: DataFrame) -> DataFrame:
    """(threshold, precision, recall) per distinct probability, ending at (1, 0)."""
    keys = ["model_name"]
    top = _from_top(score_counts(scored, keys), keys)
    points = top.select(*keys, F.col("p").alias("threshold"), ratio(F.col("tp"), F.col("cum_n")).alias("precision"),
                        ratio(F.col("tp"), F.col("positives")).alias("recall"))
    end = scored.select(*keys).distinct().select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def calibration_table(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean probability and observed rate per quantile bin; empty bins are left out.

    A bin holds the probabilities above its lower inner edge, up to and including the upper one.
    """
    inner = [f"e{i}" for i in range(1, bins)]
    edges = exact_percentiles(scored.withColumn("p", half_up("p", 5)), ["model_name"], "p",
                              [i / bins for i in range(1, bins)], inner, bounded=True) \
        .select("model_name", F.array(*inner).alias("edges"))
    binned = score_counts(scored).join(edges, "model_name").withColumn(
        "bin", F.size(F.filter("edges", lambda e: e < F.col("p"))))
    weighted = F.sum((F.col("p").cast(P5) * F.col("n").cast("decimal(18,0)")).cast("decimal(38,5)"))
    return binned.groupBy("model_name", "bin").agg(
        F.sum("n").alias("n"), ratio(weighted, F.sum("n")).alias("mean_predicted"),
        ratio(F.sum("pos"), F.sum("n")).alias("observed_rate"))


# ---------------------------------------------------------------- rank based
def _reached(scored: DataFrame, ranks: DataFrame, key: str) -> DataFrame:
    """ranks (model_name, cut_id, rank) with pos: the positives among the `rank` rows with the highest
    probabilities, ties in hash order of the key.

    Counts per probability answer all but the cuts inside a tied value. For those, counts per hash prefix
    find the place in the tie, and only the rows of one prefix are put in order.
    """
    spark, tie = scored.sparkSession, ["model_name", "p"]
    cum = _from_top(score_counts(scored), ["model_name"])
    at = cum.join(ranks, "model_name").where(F.col("rank").between(F.col("cum_n") - F.col("n") + 1, F.col("cum_n")))
    at = written_table(spark, at.select(
        *tie, "cut_id", "rank", "n", "pos", (F.col("tp") - F.col("pos")).alias("above"),
        (F.col("rank") - (F.col("cum_n") - F.col("n"))).alias("within")))          # a row per cut
    whole = at.where("within = n").select("model_name", "cut_id", "rank", (F.col("above") + F.col("pos")).alias("pos"))
    inside = at.where("within < n")
    rows = scored.withColumn("p", half_up("p", 5)).withColumn("_tie", hash_order("lift", key)) \
        .select(*tie, F.col("y").cast("bigint").alias("y"), "_tie", F.substring("_tie", 1, PREFIX_CHARS).alias("_prefix")) \
        .join(inside.select(*tie).distinct(), tie)
    upto = Window.partitionBy(*tie).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    slots = rows.groupBy(*tie, "_prefix").agg(F.count("*").alias("_n"), F.sum("y").alias("_y")) \
        .select(*tie, "_prefix", "_n", F.sum("_n").over(upto).alias("_upto"), (F.sum("_y").over(upto) - F.col("_y")).alias("_before"))
    hit = slots.join(inside, tie).where(F.col("within").between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
    hit = written_table(spark, hit.select(
        *tie, "cut_id", "rank", "_prefix", (F.col("above") + F.col("_before")).alias("above"),
        (F.col("within") - (F.col("_upto") - F.col("_n"))).alias("_nth")))
    member = Window.partitionBy(*tie, "_prefix").orderBy("_tie")
    near = rows.join(hit.select(*tie, "_prefix").distinct(), [*tie, "_prefix"]).select(
        *tie, "_prefix", F.row_number().over(member).alias("_nth"),
        F.sum("y").over(member.rowsBetween(Window.unboundedPreceding, 0)).alias("_y"))
    part = near.join(hit, [*tie, "_prefix", "_nth"]).select("model_name", "cut_id", "rank", (F.col("above") + F.col("_y")).alias("pos"))
    return whole.unionByName(part)


def _model_sizes(scored: DataFrame) -> DataFrame:
    return scored.groupBy("model_name").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("bigint")).alias("positives"),
                                            F.count("y").alias("known"))


def top_decile_lift(scored: DataFrame, fraction: float = 0.10, key: str = "customer_id") -> DataFrame:
    """Positive rate among the top share of customers over the base rate, ties in hash order of the key."""
    sizes = _model_sizes(scored)
    n_top = F.greatest(F.floor(F.col("n") * F.lit(fraction) + 1e-9), F.lit(1))
    reached = _reached(scored, sizes.select("model_name", F.lit(1).alias("cut_id"), n_top.alias("rank")), key)
    return reached.join(sizes, "model_name").select(
        "model_name", F.try_divide(ratio(F.col("pos"), F.col("rank")),
                                   ratio(F.col("positives"), F.col("known"))).alias("top_decile_lift"))


def cumulative_gains(scored: DataFrame, steps: int = 100, key: str = "customer_id") -> DataFrame:
    """Share of positives reached when contacting the top k of `steps` equal shares."""
    sizes = _model_sizes(scored)
    ranks = sizes.select("model_name", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("cut_id"), "n", "positives").select(
        "model_name", "cut_id", "positives", F.floor(F.col("n") * F.col("cut_id") / steps).alias("rank"))
    reached = _reached(scored, ranks.where(F.col("rank") > 0).select("model_name", "cut_id", "rank"), key)
    return ranks.join(reached.drop("rank"), ["model_name", "cut_id"], "left").select(
        "model_name", F.col("cut_id").alias("step"),
        ratio(F.col("cut_id"), F.lit(steps)).alias("share_contacted"), F.col("rank").alias("contacted"),
        ratio(F.coalesce("pos", F.lit(0)), F.col("positives")).alias("share_reached"))


# ---------------------------------------------------------------- campaign
def expected_profit(scored: DataFrame, threshold: float, econ: Economics = Economics(),
                    keys: list[str] = ("model_name",)) -> DataFrame:
    """Value of contacting everyone at or above the threshold."""
    hit = F.col("p") >= threshold
    saved = F.coalesce(F.sum(F.when(hit & (F.col("y") == 1), F.col("monthly_charges"))).cast("double"), F.lit(0.0))
    return scored.groupBy(*keys).agg(
        F.lit(float(threshold)).alias("threshold"), F.count_if(hit).alias("contacted"),
        (F.lit(econ.success_rate) * F.lit(econ.months_saved) * saved
         - F.lit(econ.offer_cost) * F.count_if(hit)).alias("profit"))


def threshold_grid(low: int = 5, high: int = 90) -> list[float]:
    return [k / 100 for k in range(low, high + 1)]


def threshold_sums(scored: DataFrame, grid: list[float], keys: list[str] = ("model_name",)) -> DataFrame:
    """Per key and threshold: customers and lost charges at or above it.

    Each distinct probability goes to the highest threshold it reaches; a running sum from the top
    over the grid then gives all thresholds at once, without pairing thresholds and customers.
    """
    keys = list(keys)
    thresholds = F.array(*[F.lit(t) for t in sorted(grid)])
    counts = score_counts(scored, keys).withColumn(
        "slot", F.size(F.filter(thresholds, lambda t: t <= F.col("p"))))
    sums = counts.groupBy(*keys, "slot").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum("pos_charges"), F.lit(0)).alias("charges"),
        F.sum("pos").alias("pos"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("base"), F.sum("pos").alias("base_pos"))
    full = totals.select(*keys, "base", "base_pos", F.posexplode(thresholds).alias("i", "threshold")) \
        .withColumn("slot", F.col("i") + 1).join(sums, [*keys, "slot"], "left")
    above = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(F.desc("slot")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def over(c):
        return F.sum(F.coalesce(c, F.lit(0))).over(above)

    return full.select(*keys, "threshold", "base", "base_pos", over("n").alias("contacted"),
                       over("pos").alias("hits"), over("charges").cast("double").alias("charges"))


def profit_curve(scored: DataFrame, econ: Economics = Economics(), grid: list[float] | None = None,
                 keys: list[str] = ("model_name",)) -> DataFrame:
    sums = threshold_sums(scored, grid or threshold_grid(), keys)
    return sums.select(
        *keys, "threshold",
        (F.lit(econ.success_rate) * F.lit(econ.months_saved) * F.col("charges")
         - F.lit(econ.offer_cost) * F.col("contacted")).alias("profit"),
        ratio(F.col("contacted"), F.col("base")).alias("targeted_pct"))


def best_threshold(curve: DataFrame, keys: list[str] = ("model_name",)) -> DataFrame:
    """Threshold with the highest profit, the lowest one on ties."""
    best = F.max(F.struct(F.col("profit"), (-F.col("threshold")).alias("minus"))).alias("b")
    return curve.groupBy(*keys).agg(best).select(*keys, (-F.col("b.minus")).alias("threshold"),
                                                 F.col("b.profit").alias("profit"))


def campaign_vs_contact_all(valid: DataFrame, test: DataFrame, econ: Economics = Economics()) -> DataFrame:
    """Per model: threshold chosen on one split, its value on another, and the value of contacting all."""
    best = written_table(test.sparkSession, best_threshold(profit_curve(valid, econ)).select("model_name", "threshold"))
    rows = test.join(best, "model_name")
    hit, churned = F.col("p") >= F.col("threshold"), F.col("y") == 1

    def value(chosen: Column) -> Column:
        saved = F.sum(F.when(chosen & churned, F.col("monthly_charges")).otherwise(0)).cast("double")
        return F.lit(econ.success_rate) * F.lit(econ.months_saved) * saved - F.lit(econ.offer_cost) * F.count_if(chosen)

    return rows.groupBy("model_name", "threshold").agg(
        value(hit).alias("campaign_value"), value(F.lit(True)).alias("contact_all_value"))


def campaign_simulator(scored: DataFrame, threshold: float, econ: Economics = Economics(),
                       split: str = "test") -> DataFrame:
    """One row of campaign figures for one split."""
    here = scored.where(F.col("split") == split)
    hit, churned = F.col("p") >= threshold, F.col("y") == 1
    one = here.agg(
        F.count("*").alias("customers"), F.count_if(hit).alias("contacted"),
        F.count_if(hit & churned).alias("hits"), F.count_if(churned).alias("churners"),
        F.coalesce(F.sum(F.when(hit & churned, F.col("monthly_charges"))).cast("double"), F.lit(0.0)).alias("c"))
    cost = F.col("contacted") * F.lit(econ.offer_cost)
    kept = F.lit(econ.success_rate) * F.lit(econ.months_saved) * F.col("c")
    return one.select(
        "customers", "contacted", "hits", "churners",
        F.coalesce(ratio(F.col("hits"), F.col("churners")), F.lit(0.0)).alias("recall"),
        F.coalesce(ratio(F.col("hits"), F.col("contacted")), F.lit(0.0)).alias("precision"),
        cost.alias("cost"), kept.alias("revenue_retained"), (kept - cost).alias("net_value"),
        F.coalesce(F.try_divide(kept - cost, cost), F.lit(0.0)).alias("roi"))


# ---------------------------------------------------------------- model tables
def classification_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """All metrics per model."""
    keys = ["model_name"]
    counts = written_table(scored.sparkSession, score_counts(scored, keys))
    out = auc_of_counts(counts, keys)
    for part in (ap_of_counts(counts, keys), brier_of_counts(counts, keys),
                 threshold_of_counts(counts, keys, threshold), top_decile_lift(scored)):
        out = out.join(part, keys)
    return out


def model_comparison(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Test metrics and validation AUC of every model, best validation AUC first."""
    test = classification_metrics(scored.where(F.col("split") == "test"), threshold)
    valid = auc_of_counts(score_counts(scored.where(F.col("split") == "valid")), ["model_name"], "valid_roc_auc")
    return test.join(valid, "model_name").orderBy(F.desc("valid_roc_auc"), "model_name")


def select_best_model(comparison: DataFrame) -> DataFrame:
    """Highest validation AUC; the first name on ties."""
    top = comparison.agg(F.max("valid_roc_auc")).scalar()
    return comparison.where(F.col("valid_roc_auc") == top).agg(
        F.min("model_name").alias("model_name"), F.max("valid_roc_auc").alias("valid_roc_auc"))


def run_summary(scored: DataFrame, econ: Economics = Economics()) -> DataFrame:
    """One row: best model, its threshold, test metrics there, campaign value against contacting all,
    and the whole as JSON. The winner is chosen in the plan, so only its rows are measured again."""
    valid_rows = scored.where(F.col("split") == "valid")
    winner = select_best_model(auc_of_counts(score_counts(valid_rows), ["model_name"], "valid_roc_auc"))
    name = winner.select("model_name").scalar()
    mine = scored.where(F.col("model_name") == name)
    values = campaign_vs_contact_all(mine.where(F.col("split") == "valid"), mine.where(F.col("split") == "test"), econ)
    test = mine.where(F.col("split") == "test")
    counts = score_counts(test)
    t = values.select("threshold").scalar()
    called = counts.withColumn("hit", F.col("p") >= t).groupBy("model_name").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("called"),
        F.sum(F.when(F.col("hit"), F.col("pos")).otherwise(0)).alias("tp"), F.sum("pos").alias("positives"))
    at_t = called.select(
        "model_name", F.coalesce(ratio(F.col("tp"), F.col("called")), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("positives")), F.lit(0.0)).alias("recall"))
    out = values.join(auc_of_counts(counts, ["model_name"]), "model_name").join(at_t, "model_name") \
        .select(F.col("model_name").alias("best_model"), "threshold", "roc_auc", "precision", "recall",
                "campaign_value", "contact_all_value")
    return out.withColumn("summary", F.to_json(F.struct(*out.columns)))


def permutation_importance(rows: DataFrame, features: list[str], predict, repeats: int = 5,
                           seed=42, key: str = "customer_id") -> DataFrame:
    """Mean AUC drop per feature when its values are shuffled between customers.

    `predict` is a function DataFrame -> DataFrame adding p (five digits); rows carry y, the key and
    all features. Customers are ranked once in hash order; repeat r of a feature takes the value of
    the customer a fixed number of places further on. Every (feature, repeat) is scored and measured
    in one plan. Nothing is sampled. Customers and donors meet in a merge join: as a file the ranked table
    is small (labels are dictionary codes there), as rows in a broadcast it would fill the driver. Tests that
    give a customer the same inputs are scored once: p must follow from the row alone.
    """
    ranked = hash_rank(rows.select(key, "y", *features), key, seed, "_rank").withColumn("_rank", F.col("_rank") - 1)
    ranked = written_table(rows.sparkSession, ranked)           # read on both sides of the join
    n = rows.agg(F.count("*")).scalar()
    types = dict(rows.dtypes)
    # Only (place, test, value) travels per test; the wide row travels once. Test 0 is the customer's own value.
    values = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat"),
                 F.lit(shift_of(seed, i, r)).cast("bigint").alias("_shift"), F.col(f).cast("string").alias("_value"))
        for i, f in enumerate(features) for r in range(repeats + 1)]))
    place = (F.col("_rank") - 1 - F.col("_shift") % F.greatest(n - 1, F.lit(1)) + n) % n
    donors = ranked.select("_rank", values.alias("_t")).select("_rank", "_t.*").select(
        F.when(F.col("repeat") == 0, F.col("_rank")).otherwise(place).alias("_rank"), "feature", "repeat", "_value")
    same = donors.repartition("_rank").groupBy("_rank", "feature", "_value").agg(F.collect_list("repeat").alias("_repeats"))
    own = F.array_contains("_repeats", 0)
    changes = same.select("_rank", F.when(~own, F.struct("feature", "_value")).alias("_change"), F.transform(
        F.array_remove("_repeats", 0), lambda r: F.struct(F.col("feature").alias("feature"), r.alias("repeat"))).alias("_tests"))
    changes = changes.groupBy("_rank", "_change").agg(F.flatten(F.collect_list("_tests")).alias("_tests")) \
        .where(F.size("_tests") > 0)
    mixed = ranked.hint("merge").join(changes, "_rank").withColumns({
        f: F.when(F.col("_change.feature") == f, F.col("_change._value").cast(types[f])).otherwise(F.col(f)) for f in features
    }).drop("_change", "_rank")
    base = auc_of_counts(score_counts(predict(rows), []), [], "base").select("base").scalar()
    tests = predict(mixed).select("y", "p", F.explode("_tests").alias("_test")).select("y", "p", "_test.*")
    aucs = auc_of_counts(score_counts(tests, ["feature", "repeat"]), ["feature", "repeat"])
    drops = aucs.select("feature", (base - F.col("roc_auc")).alias("_drop"))
    return drops.groupBy("feature").agg(F.avg("_drop").alias("auc_drop"), F.stddev_pop("_drop").alias("std"))


def shift_of(seed, feature_index: int, repeat: int) -> int:
    """Places between a customer and the donor of a value (a fixed large step per test)."""
    return 7919 * (feature_index + 1) + 104729 * repeat + int(seed)


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("auc_drop"), "feature").limit(k)
