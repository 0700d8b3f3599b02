from pyspark.sql import functions as F

from tenura.functions import features as X
from tenura.operators import star


def tables(raw):
    f = X.build_features(raw)
    dims = star.dim_contract(f), star.dim_payment(f), star.dim_internet(f)
    return f, star.fact_subscription(f, *dims), dims


def test_dimensions(raw_sample):
    _, _, (contracts, payments, internets) = tables(raw_sample)
    assert [tuple(r) for r in contracts.orderBy("contract_key").collect()] == \
        [(1, "Month-to-month", 1), (2, "One year", 12), (3, "Two year", 24)]
    assert [tuple(r) for r in payments.orderBy("payment_key").collect()] == \
        [(1, "Bank transfer (automatic)", 1), (2, "Credit card (automatic)", 1),
         (3, "Electronic check", 0), (4, "Mailed check", 0)]
    assert [tuple(r) for r in internets.orderBy("internet_key").collect()] == [(1, "DSL"), (2, "Fiber optic"), (3, "No")]


def test_bands(spark):
    got = [tuple(r) for r in star.dim_tenure_band(spark).orderBy("band_order").collect()]
    assert got == [("0-6m", 1), ("7-12m", 2), ("13-24m", 3), ("25-48m", 4), ("49-60m", 5), ("61m+", 6)]


def test_round_trip_through_the_star(raw_sample):
    f, fact, dims = tables(raw_sample)
    c360 = star.customer_360(fact, star.dim_customer(f), *dims)
    assert c360.count() == 6 and len(c360.columns) == 22
    bridge = star.unpivot_addons(f)
    assert bridge.groupBy("customer_id").count().where("count <> 6").count() == 0
    mart = star.feature_mart(c360, star.pivot_addons(bridge), star.peer_prices(c360), star.tenure_ranks(c360))
    rows = mart.orderBy("customer_id").collect()
    assert [r.customer_id for r in rows] == ["c1", "c2", "c3", "c4", "c5", "c6"]
    assert all(r.tech_support is not None for r in rows)
    assert fact.agg(F.sum("churn")).first()[0] == 2


def test_relative_features(raw_sample):
    f, fact, dims = tables(raw_sample)
    c360 = star.customer_360(fact, star.dim_customer(f), *dims)
    price = {r.customer_id: r.price_vs_peers for r in star.price_vs_peers(c360, star.peer_prices(c360)).collect()}
    mean = (90 + 99.65) / 2                                      # fiber, month-to-month: c3 and c6
    assert abs(price["c3"] - (90 - mean)) < 1e-4 and price["c2"] == 0
    rank = {r.customer_id: r.tenure_pct_in_contract
            for r in star.tenure_pct_in_contract(c360, star.tenure_ranks(c360)).collect()}
    assert (rank["c3"], rank["c6"], rank["c1"]) == (0.0, 0.5, 1.0)
    assert rank["c2"] == 0.0                                     # alone in its contract


def test_customers_without_labels_are_kept(spark):
    from pyspark.sql import functions as F
    from conftest import customers, raw_frame
    from tenura.functions import features as X

    rows = X.build_features(raw_frame(spark, customers())).withColumn(
        "contract", F.when(F.col("customer_id") != "c2", F.col("contract")))
    dims = star.dim_contract(rows), star.dim_payment(rows), star.dim_internet(rows)
    fact = star.fact_subscription(rows, *dims)
    view = star.customer_360(fact, star.dim_customer(rows), *dims)
    wide = star.tenure_pct_in_contract(star.price_vs_peers(view, star.peer_prices(view)), star.tenure_ranks(view))
    assert fact.count() == view.count() == wide.count() == 6
    lost = wide.where("customer_id = 'c2'").first()
    assert lost.contract_type is None and lost.price_vs_peers == 0.0
