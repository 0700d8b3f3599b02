"""Builds the 21-column subscription extract from order tables.

A customer's subscription starts at one of the first ten orders and is described by the last one.
Nothing here gathers all orders of a customer in one task: the counts and the last order are
map-side combined aggregates, and the first ten come from a window whose `rn <= 10` filter Spark
applies before the shuffle as well (window group limit), so a customer holding a third of all
orders sends at most ten rows per map task.
"""

from pyspark.sql import DataFrame, Window, functions as F

from tenura.functions import domain as D

# Product family that stands for each add-on, in the order of domain.ADDONS.
ADDON_FAMILIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ADDON_MIN_ITEMS = 8
CHURN_AFTER_DAYS = 365
START_WITHIN = 10


def _case(value, labels, otherwise=None):
    out = None
    for key, label in labels:
        out = F.when(value == key, label) if out is None else out.when(value == key, label)
    return out.otherwise(otherwise) if otherwise is not None else out


def order_history(orders: DataFrame) -> DataFrame:
    """One row per customer: order count, first day of the subscription, last order."""
    last = orders.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")).alias("last"),
    )
    by_customer = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    first = (
        orders.select("o_custkey", "o_orderkey", "o_orderdate")
        .withColumn("rn", F.row_number().over(by_customer))
        .where(F.col("rn") <= START_WITHIN)
        .select("o_custkey", "rn", F.col("o_orderdate").alias("start_at"))
    )
    wanted = 1 + F.col("o_custkey") % F.least(F.col("n_orders"), F.lit(START_WITHIN))
    return last.join(first, "o_custkey").where(F.col("rn") == wanted).select(
        "o_custkey", F.to_date("start_at").alias("start_day"),
        F.to_date("last.o_orderdate").alias("last_day"),
        F.col("last.o_orderstatus").alias("last_status"),
        F.col("last.o_orderpriority").alias("last_priority"),
    )


def addon_items(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Line items per customer and product family.

    Items are combined per order before the join with orders, and per customer after it, so hot
    orders and hot customers shrink on the map side. The part join is left to Catalyst: broadcast
    when the part table's size allows, otherwise a sort-merge join whose hot keys AQE splits.
    """
    families = part.select("p_partkey", F.substring_index("p_type", " ", 1).alias("family"))
    per_order = (
        lineitem.select("l_orderkey", "l_partkey")
        .join(families, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(*[F.count_if(F.col("family") == f).alias(a) for f, a in zip(ADDON_FAMILIES, D.ADDONS)])
    )
    return (
        per_order.join(orders.select("o_orderkey", "o_custkey"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(*[F.sum(a).alias(a) for a in D.ADDONS])
    )


def subscriptions(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                  part: DataFrame) -> DataFrame:
    """The raw extract: every column text, as a delimited file would deliver it."""
    snapshot_day = orders.select(F.to_date(F.max("o_orderdate"))).scalar()
    items = addon_items(orders, lineitem, part)
    base = (
        customer.select("c_custkey", "c_acctbal", "c_mktsegment")
        .join(order_history(orders), F.col("c_custkey") == F.col("o_custkey"))
        .drop("o_custkey")
        .join(items, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumn("snapshot_day", snapshot_day)
    )
    key = F.col("c_custkey")
    churned = F.datediff("snapshot_day", "last_day") > CHURN_AFTER_DAYS
    end_day = F.when(churned, F.col("last_day")).otherwise(F.col("snapshot_day"))
    cents = 1800 + (key * 37) % 10000
    base = base.withColumns({
        "months": F.floor(F.datediff(end_day, F.col("start_day")) / 30),
        "cents": cents,
        "internet": F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "DSL")
        .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "Fiber optic").otherwise("No"),
        "phone": key % 10 != 0,
    })
    total_cents = F.expr("(cents * months * (90 + c_custkey % 21)) div 100")

    def yes_no(condition):
        return F.when(condition, "Yes").otherwise("No")

    def money(amount):
        return (amount / 100).cast(D.MONEY).cast("string")

    urgency = F.substring("last_priority", 1, 1)
    addons = {
        raw: F.when(F.col("internet") == "No", "No internet service")
        .otherwise(yes_no(F.coalesce(F.col(name), F.lit(0)) >= ADDON_MIN_ITEMS))
        for raw, name in zip(D.RAW_COLUMNS[9:15], D.ADDONS)
    }
    values = {
        "customerID": key.cast("string"),
        "gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
        "SeniorCitizen": F.when(F.col("c_acctbal") < 0, "1").otherwise("0"),
        "Partner": yes_no(key % 3 == 0),
        "Dependents": yes_no(key % 5 == 0),
        "tenure": F.col("months").cast("string"),
        "PhoneService": yes_no(F.col("phone")),
        "MultipleLines": F.when(~F.col("phone"), "No phone service").otherwise(yes_no(key % 4 == 0)),
        "InternetService": F.col("internet"),
        **addons,
        "Contract": _case(F.col("last_status"),
                          [("P", "Month-to-month"), ("O", "One year"), ("F", "Two year")]),
        "PaperlessBilling": yes_no(key % 7 < 4),
        "PaymentMethod": _case(urgency, [("1", "Electronic check"), ("2", "Mailed check"),
                                         ("3", "Bank transfer (automatic)")],
                               "Credit card (automatic)"),
        "MonthlyCharges": money(F.col("cents")),
        "TotalCharges": F.when(F.col("months") == 0, " ").otherwise(money(total_cents)),
        "Churn": yes_no(churned),
    }
    return base.select([values[c].alias(c) for c in D.RAW_COLUMNS])


def activity_spans(events: DataFrame, quiet_days: int = 3) -> DataFrame:
    """Second survival data set: per user, days of activity and whether activity has stopped."""
    last_day = events.select(F.to_date(F.max("ts"))).scalar()
    spans = events.groupBy("user_id").agg(
        F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("final_day"),
        F.count("*").alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
    return spans.select(
        "user_id", F.datediff("final_day", "first_day").alias("duration"),
        (F.datediff(last_day, F.col("final_day")) > quiet_days).cast("int").alias("stopped"),
        "n_events", "value")
