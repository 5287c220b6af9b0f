"""KPI tests: the built tables against their grain, a second computation and
the KPI definitions. Each check yields PASS, FAIL or REVIEW rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators.quality import union
from tradewind.schema import RETENTION_CODES
from tradewind.sources import readers

# table -> (expected grain, key columns)
GRAINS = {
    "gold_fact_orders": ("one row per order_id", ["order_id"]),
    "gold_fact_order_items": (
        "one row per (order_id, order_item_id)", ["order_id", "order_item_id"]),
    "gold_fact_order_payments": (
        "one row per (order_id, payment_sequential)", ["order_id", "payment_sequential"]),
    "gold_fact_order_reviews": ("one row per (review_id, order_id)", ["review_id", "order_id"]),
    "gold_customer_delivered_orders": (
        "one row per delivered order_id with customer_unique_id", ["order_id"]),
    "dash_kpi_monthly": ("one row per report_month", ["report_month"]),
    "dash_retention_snapshot": ("one row per metric_code at dataset as-of", ["metric_code"]),
    "dash_retention_monthly": (
        "one row per (report_month, metric_code)", ["report_month", "metric_code"]),
}


def _pass(ok: Column, otherwise: str = "FAIL") -> Column:
    return F.when(ok, "PASS").otherwise(otherwise)


def grain(tables) -> DataFrame:
    """Rows against distinct keys. A key of several columns counts as a tuple,
    so a NULL part still makes a key; a single NULL key does not."""
    frames = []
    for table, (text, keys) in GRAINS.items():
        key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
        frames.append(tables[table].agg(
            F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("distinct_keys"),
        ).select(F.lit(table).alias("table_name"), F.lit(text).alias("expected_grain"), "*"))
    extra = F.col("total_rows") - F.col("distinct_keys")
    return union(frames).withColumn("duplicate_rows", extra).withColumn(
        "status", _pass(F.col("duplicate_rows") == 0))


def retention_codes(snapshot: DataFrame, monthly: DataFrame) -> DataFrame:
    """All five metric codes, in the snapshot and in every month."""
    spark = snapshot.sparkSession
    wanted = readers.values(spark, "metric_code string", [(c,) for c in RETENTION_CODES])
    found = snapshot.select("metric_code").distinct()
    missing = wanted.join(found, "metric_code", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    n = len(RETENTION_CODES)
    first = (
        found.agg(F.count(F.lit(1)).alias("actual_count"))
        .withColumn("missing_count", missing.scalar())
        .select(
            F.lit("dash_retention_snapshot metric codes").alias("check_name"),
            F.lit(n).cast("long").alias("expected_count"), "actual_count", "missing_count",
            _pass((F.col("missing_count") == 0) & (F.col("actual_count") == n)).alias("status")))
    per_month = monthly.groupBy("report_month").agg(F.countDistinct("metric_code").alias("codes"))
    second = per_month.agg(
        F.min("codes").alias("actual_count"),
        F.count_if(F.col("codes") != n).alias("missing_count"),
    ).select(
        F.lit("dash_retention_monthly has 5 metric codes per month").alias("check_name"),
        F.lit(n).cast("long").alias("expected_count"), "actual_count", "missing_count",
        _pass(F.col("missing_count") == 0).alias("status"))
    return first.unionByName(second)


def monthly_from_facts(
    fact_orders: DataFrame, fact_items: DataFrame, fact_payments: DataFrame,
    fact_reviews: DataFrame,
) -> DataFrame:
    """The monthly KPIs from line-level facts, a second way to the mart's values."""
    month = F.col("order_purchase_month").alias("report_month")
    col = F.col

    def per_month(df: DataFrame, *measures: Column) -> DataFrame:
        return df.filter("order_purchase_month IS NOT NULL").groupBy(month).agg(*measures)

    orders = per_month(
        fact_orders.filter("is_delivered"),
        F.count(F.lit(1)).alias("delivered"),
        F.count_if("is_valid_for_delivery_delay_kpi").alias("judged"),
        F.count_if("is_delayed").alias("late"),
        F.count_if("uses_installments").alias("split"))
    items = per_month(
        fact_items.filter("is_delivered"),
        F.sum("line_gmv").alias("sum_gmv"), F.countDistinct("order_id").alias("sold"))
    payments = per_month(
        fact_payments.filter("is_delivered"), F.sum("payment_value").alias("paid"))
    reviews = per_month(fact_reviews, F.avg("review_score").alias("avg_review_score"))
    return (
        orders.join(items, "report_month", "left").join(payments, "report_month", "left")
        .join(reviews, "report_month", "left")
        .select(
            "report_month",
            F.coalesce("sum_gmv", F.lit(0)).alias("gmv"),
            F.coalesce("sold", F.lit(0)).alias("total_orders"),
            C.ratio(col("sum_gmv"), col("sold")).alias("aov"),
            F.coalesce("paid", F.lit(0)).alias("actual_payment"),
            C.ratio(col("late"), col("judged")).alias("delivery_delay_rate"),
            "avg_review_score",
            C.ratio(col("split"), col("delivered")).alias("installment_usage_rate"),
        )
    )


# Tolerance of each recomputed KPI.
MONTHLY_TOLERANCE = {
    "gmv": 0.01,
    "total_orders": 0.0,
    "aov": 0.000001,
    "actual_payment": 0.01,
    "delivery_delay_rate": 0.000001,
    "avg_review_score": 0.000001,
    "installment_usage_rate": 0.000001,
}


def _largest_gaps(both: DataFrame, tolerance: dict[str, float], counted: str) -> DataFrame:
    """Largest |a - b| of each KPI over rows aliased a and b."""
    gaps = {k: F.max(F.abs(F.col(f"a.{k}") - F.col(f"b.{k}"))) for k in tolerance}
    wide = both.agg(F.count(F.lit(1)).alias(counted),
                    *[g.alias(f"max_{k}_diff") for k, g in gaps.items()])
    within = [F.col(f"max_{k}_diff") <= F.lit(t) for k, t in tolerance.items()]
    return wide.withColumn("status", _pass(reduce(lambda x, y: x & y, within)))


def monthly_metrics(mart: DataFrame, recomputed: DataFrame) -> DataFrame:
    both = mart.alias("a").join(
        recomputed.alias("b"), F.col("a.report_month") == F.col("b.report_month"))
    return _largest_gaps(both, MONTHLY_TOLERANCE, "months_checked")


def category_metrics(mart: DataFrame, fact_items: DataFrame) -> DataFrame:
    """Category sums recomputed per (month, category, label); a NULL category is
    compared as well."""
    keys = ["report_month", "category", "category_label"]
    again = (
        fact_items.filter("is_delivered AND order_purchase_month IS NOT NULL")
        .select(F.col("order_purchase_month").alias("report_month"),
                F.col("product_category_name_english").alias("category"),
                F.col("product_category_label").alias("category_label"), "line_gmv", "order_id")
        .groupBy(*keys, "order_id").agg(F.sum("line_gmv").alias("gmv"))
        .groupBy(*keys)
        .agg(F.sum("gmv").alias("category_gmv"),
             F.count("order_id").alias("category_order_count"))
    )
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = mart.alias("a").join(again.alias("b"), reduce(lambda x, y: x & y, same))
    return _largest_gaps(
        both, {"category_gmv": 0.01, "category_order_count": 0.0}, "category_months_checked")


def retention_recomputed(delivered: DataFrame, dates: DataFrame) -> DataFrame:
    """The snapshot from customer sets: inside a window, before it, and order
    counts, each computed on its own."""
    moment = dates.select("as_of_timestamp").scalar()
    rows = delivered.withColumn("as_of", moment)
    ts, person = F.col("order_purchase_timestamp"), "customer_unique_id"

    def repeats(df: DataFrame, code: str) -> DataFrame:
        per = df.groupBy(person).agg(F.countDistinct("order_id").alias("n"))
        return per.agg(F.count(F.lit(1)).alias("total_customers"),
                       F.count_if(F.col("n") > 1).alias("returning_customers")
                       ).select(F.lit(code).alias("metric_code"), "*")

    frames = [repeats(rows.filter(ts <= F.col("as_of")), "lifetime_repeat_purchase")]
    for months in (3, 6):
        start = C.months_before(F.col("as_of"), months)
        inside = rows.filter((ts > start) & (ts <= F.col("as_of")))
        earlier = rows.filter(ts <= start).select(person).distinct().withColumn(
            "earlier", F.lit(True))
        met = inside.select(person).distinct().join(earlier, person, "left")
        frames.append(met.agg(F.count(F.lit(1)).alias("total_customers"),
                              F.count("earlier").alias("returning_customers"))
                      .select(F.lit(f"last_{months}m_returning_customer").alias("metric_code"),
                              "*"))
        frames.append(repeats(inside, f"last_{months}m_repeat_purchase"))
    return union(frames)


def retention_metrics(snapshot: DataFrame, recomputed: DataFrame) -> DataFrame:
    again = recomputed.select(
        "metric_code", F.col("total_customers").alias("recalculated_total_customers"),
        F.col("returning_customers").alias("recalculated_returning_customers"))
    rate = C.ratio(F.col("recalculated_returning_customers"),
                   F.col("recalculated_total_customers"))
    both = snapshot.join(again, "metric_code").withColumn(
        "rate_diff", F.abs(F.col("repeat_purchase_rate") - rate))
    same = (
        (F.col("total_customers") == F.col("recalculated_total_customers"))
        & (F.col("returning_customers") == F.col("recalculated_returning_customers"))
        & (F.col("rate_diff") <= 0.000001)
    )
    return both.select(
        "metric_code",
        F.col("total_customers").alias("dash_total_customers"),
        "recalculated_total_customers",
        F.col("returning_customers").alias("dash_returning_customers"),
        "recalculated_returning_customers",
        "rate_diff",
        _pass(same).alias("status"),
    )


def business_logic(tables) -> DataFrame:
    """Eight rules the KPI definitions imply, one row each."""
    items, payments = tables["gold_fact_order_items"], tables["gold_fact_order_payments"]
    orders, reviews = tables["gold_fact_orders"], tables["gold_fact_order_reviews"]
    delivered = tables["gold_customer_delivered_orders"]
    n = F.count(F.lit(1))

    def rule(name: str, df: DataFrame, issues: Column, why: str, good=None) -> DataFrame:
        ok = F.col("issue_count") == 0 if good is None else good
        return df.agg(issues.alias("issue_count")).select(
            F.lit(name).alias("check_name"), "issue_count", _pass(ok).alias("status"),
            F.lit(why).alias("rationale"))

    def orders_per(key: str) -> DataFrame:
        return delivered.groupBy(key).agg(F.countDistinct("order_id").alias("orders"))

    sold = items.filter("is_delivered").select("order_id").distinct()
    mixed = items.filter(~F.col("is_delivered")).join(sold, "order_id", "left_semi")
    most = payments.groupBy("order_id").agg(F.max("payment_installments").alias("most"))
    split = orders.filter("is_delivered").select("order_id", "uses_installments").distinct().join(
        most, "order_id", "left")
    status = tables["silver_orders"].select("order_id", "order_status")
    # The names of the eight checks.
    return union([
        rule("delivered-only sales facts", mixed, n,
             "no order counts as delivered on one line and not on another"),
        rule("retention uses customer_unique_id, not customer_id", orders_per("customer_id"),
             F.count_if(F.col("orders") > 1),
             "customer_id belongs to one order, so it cannot show repeat purchases"),
        rule("customer_unique_id has repeat buyers", orders_per("customer_unique_id"),
             F.count_if(F.col("orders") > 1),
             "counted by person, some customers order again", good=F.col("issue_count") > 0),
        rule("installment numerator uses payment_installments > 1", split,
             F.count_if(F.col("uses_installments") & (F.col("most") <= 1)),
             "an installment order needs a payment with more than one installment"),
        rule("payment_installments = 0 not counted as installment", payments,
             F.count_if((F.col("payment_installments") == 0) & F.col("is_installment_payment")),
             "0 installments is a data quirk, not installment use"),
        rule("delivery delay denominator excludes inconsistent delivery records", orders,
             F.count_if(F.col("is_valid_for_delivery_delay_kpi")
                        & F.col("is_delivery_inconsistency")),
             "the delay rate needs delivered orders with usable dates"),
        rule("review fact is delivered orders only", reviews.join(status, "order_id"),
             F.count_if(F.col("order_status") != "delivered"),
             "the review score covers delivered orders"),
        rule("reviews do not inflate gold_fact_orders grain", orders,
             n - F.countDistinct("order_id"),
             "reviews are aggregated to the order before they are joined"),
    ])


def window_logic(snapshot: DataFrame) -> DataFrame:
    """Returning customers are usually at least the repeat buyers of a window."""
    def value(code: str) -> Column:
        return F.max(F.when(F.col("metric_code") == code, F.col("returning_customers")))

    frames = []
    for months in (3, 6):
        returning, repeat = (f"last_{months}m_returning_customer",
                             f"last_{months}m_repeat_purchase")
        frames.append(snapshot.agg(
            value(returning).alias("left_value"), value(repeat).alias("right_value"),
        ).select(
            F.lit(f"{returning} >= {repeat} usually expected").alias("check_name"),
            "left_value", "right_value",
            _pass(F.col("left_value") >= F.col("right_value"), "REVIEW").alias("status"),
            F.lit(f"bought in the last {months} months and earlier, against more than one "
                  "order inside them").alias("rationale"),
        ))
    return union(frames)
