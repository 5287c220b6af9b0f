"""Dashboard marts over the order-grain fact.

The fact already holds item and payment totals per order, so a period's sums
need one aggregate and no further join with the line tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C


def _per_period(order_facts: DataFrame, period: Column, name: str) -> DataFrame:
    """Sums of delivered orders per period.

    Rows meet per order first. The fact comes partitioned by order_id, so this
    adds no exchange, and orders with items are counted once without a DISTINCT.
    """
    per_order = order_facts.filter("is_delivered").groupBy("order_id", period.alias(name)).agg(
        F.sum("order_gmv").alias("gmv"),
        F.sum("order_payment_total").alias("paid"),
        F.count(F.lit(1)).alias("orders"),
        F.count_if("is_valid_for_delivery_delay_kpi").alias("judged"),
        F.count_if("is_delayed").alias("late"),
        F.count_if("uses_installments").alias("split"),
        F.max(F.col("order_item_count") > 0).alias("has_items"),
        F.max(F.col("payment_row_count") > 0).alias("has_payments"),
    )
    return per_order.filter(F.col(name).isNotNull()).groupBy(name).agg(
        F.sum("gmv").alias("gmv"),
        F.count_if("has_items").alias("total_orders"),
        F.sum("paid").alias("actual_payment"),
        F.sum("orders").alias("delivered_orders"),
        F.sum("judged").alias("delivery_delay_denominator"),
        F.sum("late").alias("delayed_orders"),
        F.sum("split").alias("installment_orders"),
        F.max(F.col("has_items") | F.col("has_payments")).alias("active"),
    )


def kpi_monthly(order_facts: DataFrame, fact_reviews: DataFrame) -> DataFrame:
    """Sales, payment, delay, review and installment KPIs per month.

    Months are those with a delivered order. Sums are 0 and ratios NULL where a
    month has nothing to measure.
    """
    months = _per_period(order_facts, F.col("order_purchase_month"), "report_month")
    reviews = (
        fact_reviews.filter("order_purchase_month IS NOT NULL")
        .groupBy(F.col("order_purchase_month").alias("report_month"))
        .agg(F.count(F.lit(1)).alias("review_count"),
             F.avg("review_score").alias("avg_review_score"))
    )
    col = F.col
    return months.join(reviews, "report_month", "left").select(
        "report_month",
        "gmv",
        "total_orders",
        C.ratio(col("gmv"), col("total_orders")).alias("aov"),
        "actual_payment",
        "delivered_orders",
        "delivery_delay_denominator",
        "delayed_orders",
        C.ratio(col("delayed_orders"), col("delivery_delay_denominator"))
        .alias("delivery_delay_rate"),
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
        "avg_review_score",
        "installment_orders",
        C.ratio(col("installment_orders"), col("delivered_orders"))
        .alias("installment_usage_rate"),
    )


def kpi_daily(order_facts: DataFrame) -> DataFrame:
    """Sales and payment per day; only days with items or payments."""
    days = _per_period(order_facts, F.col("order_purchase_date"), "report_date")
    return days.filter("active").select("report_date", "gmv", "total_orders", "actual_payment")


def kpi_weekly(order_facts: DataFrame) -> DataFrame:
    """Sales and payment per ISO week (Monday start)."""
    weeks = _per_period(order_facts, F.trunc("order_purchase_date", "WEEK"), "week_start")
    return weeks.filter("active").select("week_start", "gmv", "total_orders", "actual_payment")


def category_monthly(fact_items: DataFrame) -> DataFrame:
    """Sales per month and category with the category's rank in its month.

    The rank window sees one row per category of a month.
    """
    sums = (
        fact_items.filter("is_delivered AND order_purchase_month IS NOT NULL")
        .groupBy(
            F.col("order_purchase_month").alias("report_month"),
            F.col("product_category_name_english").alias("category"),
            F.col("product_category_label").alias("category_label"),
        )
        .agg(F.sum("line_gmv").alias("category_gmv"),
             F.countDistinct("order_id").alias("category_order_count"))
    )
    order = Window.partitionBy("report_month").orderBy(
        F.col("category_gmv").desc_nulls_first(),
        F.col("category").asc_nulls_first(),
        F.col("category_label").asc_nulls_first(),
    )
    return sums.withColumn("category_rank", F.row_number().over(order))
