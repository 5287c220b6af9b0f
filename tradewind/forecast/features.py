"""Daily series, calendar spine and past-only features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C

# Feature names in model order, lags and rolling widths.
FEATURES = [
    "trend", "day_of_week", "month", "quarter", "month_sin", "month_cos",
    "gmv_lag_1", "gmv_lag_2", "gmv_lag_3", "gmv_lag_6", "gmv_lag_7",
    "gmv_rolling_mean_3", "gmv_rolling_mean_6", "gmv_rolling_mean_7", "gmv_rolling_mean_28",
    "gmv_rolling_std_3",
    "orders_lag_1", "orders_lag_7", "customers_lag_1", "customers_lag_7",
]
GMV_LAGS = (1, 2, 3, 6, 7)
MEANS = (3, 6, 7, 28)
STD = 3
OTHER_LAGS = (1, 7)
_AMOUNT = "decimal(18,2)"


def daily_metrics(fact_orders: DataFrame, series: str | None = None) -> DataFrame:
    """Delivered orders, GMV and customers per day, optionally per series."""
    keys = [F.col(series).alias("series")] if series else []
    return (
        fact_orders.filter("is_delivered AND order_purchase_date IS NOT NULL")
        .groupBy(*keys, F.col("order_purchase_date").alias("order_date"))
        .agg(F.countDistinct("order_id").alias("orders"),
             F.sum("order_gmv").alias("gmv"),
             F.countDistinct("customer_unique_id").alias("unique_customers"))
    )


def daily_spine(daily: DataFrame) -> DataFrame:
    """Continuous days per series, zero where nothing sold.

    Each series starts at its first day; all end on the same, latest day, so
    their forecasts cover the same dates.
    """
    if "series" not in daily.columns:
        daily = daily.withColumn("series", F.lit("total"))
    last = daily.agg(F.max("order_date").alias("d"))
    bounds = (
        daily.groupBy("series").agg(F.min("order_date").alias("first_date"))
        .withColumn("last_date", last.scalar())
    )
    # One row per series and day: calendar-bounded within a series.
    spine = bounds.select(
        "series", "first_date",
        F.explode(F.sequence("first_date", "last_date", F.expr("INTERVAL 1 DAY")))
        .alias("order_date"))
    return spine.join(daily, ["series", "order_date"], "left").select(
        "series", "order_date", "first_date",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("gmv", F.lit(0)).cast(_AMOUNT).alias("gmv"),
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"))


def calendar(day: Column, first: Column) -> dict[str, Column]:
    """Features that depend on the date only. Monday is 0."""
    turn = F.pi() * 2 * F.month(day) / 12
    return {
        "trend": F.datediff(day, first),
        "day_of_week": F.weekday(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "month_sin": F.sin(turn),
        "month_cos": F.cos(turn),
    }


def add_features(spine: DataFrame) -> DataFrame:
    """All features; rows without a full past hold NULLs.

    Windows never cross series, and a series is one row per calendar day.
    """
    past = Window.partitionBy("series").orderBy("order_date")
    gmv = F.col("gmv")
    columns = calendar(F.col("order_date"), F.col("first_date"))
    for n in GMV_LAGS:
        columns[f"gmv_lag_{n}"] = F.lag(gmv, n).over(past).cast("double")
    for n in MEANS:
        columns[f"gmv_rolling_mean_{n}"] = C.past_average(gmv, past, n)
    columns[f"gmv_rolling_std_{STD}"] = C.past_stddev(gmv, past, STD)
    for n in OTHER_LAGS:
        columns[f"orders_lag_{n}"] = F.lag("orders", n).over(past).cast("double")
        columns[f"customers_lag_{n}"] = F.lag("unique_customers", n).over(past).cast("double")
    return spine.select("*", *[columns[name].alias(name) for name in FEATURES])


def training_rows(featured: DataFrame) -> DataFrame:
    return featured.dropna(subset=[*FEATURES, "gmv"])
