import math
import random

import pytest
from pyspark.sql import functions as F

from tenura.operators import survival


def frame(spark, durations, events, **more):
    cols = {"tenure": durations, "churn": events, **more}
    return spark.createDataFrame(list(zip(*cols.values())), list(cols))


def curve(spark, durations, events):
    return survival.kaplan_meier(frame(spark, durations, events)).orderBy("t").collect()


def test_without_censoring_it_is_the_share_alive(spark):
    rows = curve(spark, [1, 2, 3, 4, 5], [1] * 5)
    assert [round(r.survival, 12) for r in rows] == [1.0, 0.8, 0.6, 0.4, 0.2, 0.0]
    assert rows[-1].ci_low == rows[-1].ci_high == 0.0
    assert rows[0].at_risk == 5 and rows[0].events == 0


def test_never_rises(spark):
    rng = random.Random(7)
    rows = curve(spark, [rng.randrange(72) for _ in range(500)], [rng.randrange(2) for _ in range(500)])
    s = [r.survival for r in rows]
    assert all(b <= a + 1e-12 for a, b in zip(s, s[1:]))
    assert all(r.ci_low <= r.survival + 1e-12 <= r.ci_high + 2e-12 for r in rows)


def test_censoring_raises_the_curve(spark):
    assert curve(spark, [1, 2, 3, 4, 5], [1, 0, 1, 0, 1])[-1].survival >= curve(spark, [1, 2, 3, 4, 5], [1] * 5)[-1].survival


def test_no_anchor_when_the_first_event_is_at_zero(spark):
    rows = curve(spark, [0, 1, 2], [1, 1, 0])
    assert [r.t for r in rows] == [0.0, 1.0]


def test_no_events_gives_the_anchor_only(spark):
    rows = curve(spark, [3, 4], [0, 0])
    assert [(r.t, r.at_risk, r.survival) for r in rows] == [(0.0, 2, 1.0)]


def test_median(spark):
    c = survival.kaplan_meier(frame(spark, [1, 2, 3, 4, 5], [1] * 5))
    assert survival.median_survival(c).first().median == 3
    never = survival.kaplan_meier(frame(spark, [1, 2], [0, 0]))
    assert survival.median_survival(never).first().median is None


def test_greenwood_limits_by_hand(spark):
    r = curve(spark, [1, 2, 2, 3], [1, 1, 0, 0])[2]           # t = 2: 3 at risk, 1 event
    s = 3 / 4 * 2 / 3
    var = 1 / (4 * 3) + 1 / (3 * 2)
    se = math.sqrt(var) / abs(math.log(s))
    assert math.isclose(r.survival, s) and math.isclose(r.ci_low, s ** math.exp(1.96 * se))
    assert math.isclose(r.ci_high, s ** math.exp(-1.96 * se))


@pytest.mark.parametrize("other, differs", [(30, True), (5, False)])
def test_logrank(spark, other, differs):
    rng = random.Random(11)
    a = [1 + round(rng.expovariate(1 / 5)) for _ in range(300)]
    b = [1 + round(rng.expovariate(1 / other)) for _ in range(300)]
    df = frame(spark, a + b, [1] * 600, first=[1] * 300 + [0] * 300)
    p = survival.logrank_test(df, "first").first().p_value
    assert p < 1e-6 if differs else p > 0.01


def test_summary(spark):
    df = frame(spark, [5, 13, 30, 40], [1, 1, 0, 0], kind=["x"] * 4)
    r = survival.retention_summary(df, "kind").first()
    assert (r.customers, round(r.s_12, 9), round(r.s_24, 9), r.median_months) == (4, 0.75, 0.5, 13.0)


def test_billions_at_risk_and_continuous_durations(spark):
    """Counts of seven billion customers: the arithmetic of the curve must not overflow."""
    from tenura.operators.ordering import running_totals

    counts = spark.createDataFrame([(float(t), 1_750_000_000, 700_000_000) for t in range(1, 5)], "t double, n long, events long")
    risk = running_totals(counts, [], "t", {"at_risk": "n"}, descending=True, bounded=True)
    d, n = F.col("events"), F.col("at_risk")
    top = risk.select(F.max(F.when(d < n, d / (n.cast("double") * (n - d))))).first()[0]
    assert 0 < top < 1e-9
    rows = [(i / 7, i % 3 == 0) for i in range(1, 200)]
    whole = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1, 200)], "tenure int, churn int")
    real = spark.createDataFrame([(t, int(e)) for t, e in rows], "tenure double, churn int")
    a = [round(r.survival, 12) for r in survival.kaplan_meier(whole).orderBy("t").collect()]
    b = [round(r.survival, 12) for r in survival.kaplan_meier(real).orderBy("t").collect()]
    assert a == b
