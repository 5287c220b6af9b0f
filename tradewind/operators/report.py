"""Report measures over the star schema: cards, slicers, maps and mixes.

Ratios are always recomputed from sums, never averaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C


def _mean(column: Column) -> Column:
    """Mean as double from an exact decimal sum."""
    exact = column.cast("decimal(20,10)")
    return F.sum(exact).cast("double") / F.count(exact)


def kpi_cards(fact_orders: DataFrame, period: str = "MM") -> DataFrame:
    """GMV, orders, AOV, customers and repeat rate per period (`MM` or `YYYY`).

    Orders are first summed per (period, person), so a frequent buyer is one row
    before periods meet.
    """
    start = F.trunc("order_purchase_date", period).alias("period_start")
    per_person = (
        fact_orders.filter("is_delivered AND order_purchase_date IS NOT NULL")
        .groupBy(start, "customer_unique_id")
        .agg(F.sum("order_gmv").alias("gmv"), F.countDistinct("order_id").alias("orders"))
    )
    known = F.col("customer_unique_id").isNotNull()
    sums = per_person.groupBy("period_start").agg(
        F.sum("gmv").alias("gmv"),
        F.sum("orders").alias("total_orders"),
        F.count("customer_unique_id").alias("unique_customers"),
        F.count_if(known & (F.col("orders") > 1)).alias("repeat_customers"),
    )
    return sums.withColumn("aov", C.ratio(F.col("gmv"), F.col("total_orders"))).withColumn(
        "repeat_rate", C.ratio(F.col("repeat_customers"), F.col("unique_customers")))


CARDS = ["gmv", "total_orders", "aov", "unique_customers", "repeat_rate"]


def kpi_cards_yoy(fact_orders: DataFrame, period: str = "MM") -> DataFrame:
    """Cards next to the change against the same period a year earlier."""
    now = kpi_cards(fact_orders, period)
    before = now.select(
        F.add_months("period_start", 12).alias("period_start"),
        *[F.col(c).alias(f"{c}_before") for c in CARDS])

    def change(c: str) -> Column:
        a, b = F.col(c).cast("double"), F.col(f"{c}_before").cast("double")
        return F.when(b > 0, (a - b) / b).alias(f"{c}_yoy")

    return now.join(before, "period_start", "left").select(
        "period_start", *CARDS, *[change(c) for c in CARDS])


def time_slicer(
    fact_orders: DataFrame, dim_date: DataFrame, by: list[str],
    years: list[int] | None = None, months: list[int] | None = None,
) -> DataFrame:
    """KPIs of any selection and grouping of calendar columns."""
    dates = dim_date
    if years:
        dates = dates.filter(F.col("year").isin(years))
    if months:
        dates = dates.filter(F.col("month").isin(months))
    days = dates.select("date_day", *by)
    sold = fact_orders.filter("is_delivered").withColumnRenamed("order_purchase_date", "date_day")
    # One row per calendar day.
    return sold.join(F.broadcast(days), "date_day").groupBy(*by).agg(
        F.sum("order_gmv").alias("gmv"),
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("order_payment_total").alias("actual_payment"),
        F.count_if("is_delayed").alias("delayed_orders"),
        F.count_if("is_valid_for_delivery_delay_kpi").alias("judged_orders"),
    ).withColumn("aov", C.ratio(F.col("gmv"), F.col("total_orders"))).withColumn(
        "delivery_delay_rate", C.ratio(F.col("delayed_orders"), F.col("judged_orders")))


def top_categories(
    fact_items: DataFrame, dim_customer: DataFrame, n: int = 3, by: str = "gmv",
    state: str | None = None,
) -> DataFrame:
    """The n best categories of each state by `gmv` or `orders`."""
    places = dim_customer.select("customer_id", "customer_state")
    if state:
        places = places.filter(F.col("customer_state") == state)
    sums = (
        fact_items.filter("is_delivered")
        .select("customer_id", "order_id", "product_category_name_english", "line_gmv")
        .join(places, "customer_id")
        .groupBy("customer_state", F.col("product_category_name_english").alias("category"))
        .agg(F.sum("line_gmv").alias("gmv"), F.countDistinct("order_id").alias("orders"))
    )
    order = Window.partitionBy("customer_state").orderBy(
        F.col(by).desc_nulls_last(), F.col("category").asc_nulls_first())
    return sums.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def geo_gmv(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """GMV and orders per state and city with mean coordinates."""
    places = dim_customer.select(
        "customer_id", "customer_state", "customer_city", "customer_geo_lat", "customer_geo_lng")
    return (
        fact_orders.filter("is_delivered").select("customer_id", "order_id", "order_gmv")
        .join(places, "customer_id")
        .groupBy("customer_state", "customer_city")
        .agg(F.sum("order_gmv").alias("gmv"), F.countDistinct("order_id").alias("orders"),
             _mean(F.col("customer_geo_lat")).alias("lat"),
             _mean(F.col("customer_geo_lng")).alias("lng"))
    )


def geo_review_score(fact_reviews: DataFrame, dim_customer: DataFrame) -> DataFrame:
    places = dim_customer.select("customer_id", "customer_state")
    return fact_reviews.select("customer_id", "review_score").join(places, "customer_id").groupBy(
        "customer_state").agg(F.count("review_score").alias("reviews"),
                              F.avg("review_score").alias("avg_review_score"))


def payment_mix(fact_payments: DataFrame) -> DataFrame:
    """Delivered payments by type with their share of the value."""
    delivered = fact_payments.filter("is_delivered")
    total = delivered.agg(F.sum("payment_value").cast("double").alias("t"))
    return (
        delivered.groupBy("payment_type")
        .agg(F.sum("payment_value").alias("payment_value"),
             F.count(F.lit(1)).alias("payment_rows"))
        .withColumn("value_share", F.col("payment_value").cast("double") / total.scalar())
    )


def freight_cost(fact_items: DataFrame) -> DataFrame:
    return (
        fact_items.filter("is_delivered AND order_purchase_month IS NOT NULL")
        .groupBy(F.col("order_purchase_month").alias("report_month"))
        .agg(F.coalesce(F.sum("freight_value"), F.lit(0)).alias("freight"),
             F.sum("line_gmv").alias("gmv"))
        .withColumn("freight_share", C.ratio(F.col("freight"), F.col("gmv")))
    )


def delay_vs_repeat(fact_orders: DataFrame) -> DataFrame:
    """Do customers whose first order came late buy again, and how do they rate it?

    The first order is a running minimum per person, not a sorted group.
    """
    orders = fact_orders.filter("is_delivered AND customer_unique_id IS NOT NULL")
    first = F.min(F.struct(
        "order_purchase_timestamp", "order_id", "is_delayed", "is_valid_for_delivery_delay_kpi",
        F.col("order_avg_review_score").cast("decimal(12,8)").alias("score")))
    people = orders.groupBy("customer_unique_id").agg(
        first.alias("first"), F.countDistinct("order_id").alias("orders"))
    return (
        people.filter("first.is_valid_for_delivery_delay_kpi")
        .groupBy(F.col("first.is_delayed").alias("first_order_delayed"))
        .agg(F.count(F.lit(1)).alias("customers"),
             F.count_if(F.col("orders") > 1).alias("repeat_customers"),
             _mean(F.col("first.score")).alias("avg_first_review_score"))
        .withColumn("repeat_rate", C.ratio(F.col("repeat_customers"), F.col("customers")))
    )
