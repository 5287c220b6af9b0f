"""Exploratory summaries: shapes, distributions, Pareto shares, trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import rank
from tradewind.operators.quality import measure, union
from tradewind.schema import RETENTION_CODES
from tradewind.session import settled

SHAPED = ["gold_fact_orders", "gold_fact_order_items", "gold_fact_order_payments",
          "gold_fact_order_reviews", "gold_customer_delivered_orders", "dash_kpi_monthly",
          "dash_retention_snapshot"]


def table_shapes(tables) -> DataFrame:
    some = {t: tables[t] for t in SHAPED}
    return measure(some, [
        (t, {"table_name": t, "cols": len(df.columns)}, {"rows": F.count(F.lit(1))})
        for t, df in some.items()
    ])


def value_counts(df: DataFrame, column: str, name: str = "orders") -> DataFrame:
    """Frequency and share of each value, NULL included."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
        .withColumn("pct", F.col(name).cast("double") / total.scalar())
    )


def purchase_range(fact_orders: DataFrame) -> DataFrame:
    ts = "order_purchase_timestamp"
    return fact_orders.agg(F.min(ts).alias("min_purchase_ts"), F.max(ts).alias("max_purchase_ts"))


CRITICAL = ["order_purchase_timestamp", "order_delivered_customer_date",
            "order_estimated_delivery_date", "order_payment_total", "order_avg_review_score"]


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    return measure({"t": df}, [
        ("t", {"column_name": c}, {"null_rate": F.avg(F.col(c).isNull().cast("double"))})
        for c in columns
    ])


def describe_orders(fact_orders: DataFrame) -> DataFrame:
    """Summary of two categorical columns and the purchase time.

    Categorical rows have unique / top / freq, the time row has mean and
    quartiles. Categories are counted first, so the summary reads few rows.
    """
    moment = ["mean", "min", "p25", "p50", "p75", "max"]
    none = [F.lit(None).cast("timestamp_ntz").alias(c) for c in moment]

    def categorical(column: str) -> DataFrame:
        counts = rank.value_counts(fact_orders, F.col(column).cast("string"))
        best = F.min(F.struct((-F.col("weight")).alias("w"), "value"))
        return counts.agg(
            F.sum("weight").alias("count"), F.count(F.lit(1)).alias("unique"),
            best["value"].alias("top"), (-best["w"]).alias("freq"),
        ).select(F.lit(column).alias("column_name"), "count", "unique", "top", "freq", *none)

    ts = "order_purchase_timestamp"
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    spots = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    known = fact_orders.select(micros.alias("us"))

    def back(us: Column) -> Column:
        return F.timestamp_micros(F.floor(us).cast("long")).cast("timestamp_ntz")

    whole = known.agg(
        F.count("us").alias("count"),
        C.int_div(F.sum(F.col("us").cast("decimal(38,0)")), F.count("us")).alias("mean"),
        F.min("us").alias("min"), F.max("us").alias("max"))
    times = C.beside(whole, rank.quantiles(known, F.col("us"), spots)).select(
        F.lit(ts).alias("column_name"), "count",
        F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
        F.lit(None).cast("long").alias("freq"), *[back(F.col(c)).alias(c) for c in moment])
    return union([categorical("order_status"), categorical("is_delivered"), times])


def describe_amount(df: DataFrame, column: str) -> DataFrame:
    """Count, distinct values, mean, deviation, quartiles and range of an amount."""
    value = F.col(column)
    whole = df.agg(
        F.count(value).alias("count"), F.countDistinct(value).alias("unique"),
        (F.sum(value).cast("double") / F.count(value)).alias("mean"),
        F.round(F.stddev_samp(value.cast("double")), 3).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    spots = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return C.beside(whole, rank.quantiles(df, value, spots))


def orders_per_customer(delivered: DataFrame) -> DataFrame:
    return delivered.groupBy("customer_unique_id").agg(
        F.countDistinct("order_id").alias("delivered_orders"))


def customer_frequency(delivered: DataFrame) -> DataFrame:
    n = F.col("delivered_orders")
    counts = orders_per_customer(delivered).agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(n == 1).alias("one_time_customers"),
        F.count_if(n > 1).alias("repeat_customers_gt1"),
        F.count_if(n >= 5).alias("loyal_customers_ge5"))
    rows = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
        for c in counts.columns[1:]
    ])
    return counts.select("all", F.explode(rows).alias("r")).select(
        "r.metric", "r.value", C.ratio(F.col("r.value"), F.col("all")).alias("rate"))


def order_count_distribution(delivered: DataFrame, most: int | None = None) -> DataFrame:
    """Customers by number of delivered orders; `most` is the chart's upper end."""
    counts = orders_per_customer(delivered).groupBy("delivered_orders").agg(
        F.count(F.lit(1)).alias("customers"))
    return counts.filter(F.col("delivered_orders") <= most) if most else counts


def customer_gmv(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.filter("is_delivered AND customer_unique_id IS NOT NULL")
        .groupBy("customer_unique_id").agg(F.sum("order_gmv").alias("customer_gmv"))
    )


def _by_gmv() -> list[Column]:
    return [-F.col("customer_gmv"), F.col("customer_unique_id")]


def pareto_customers(fact_orders: DataFrame) -> DataFrame:
    """Customers from the largest GMV down with cumulative shares."""
    running = rank.with_running(customer_gmv(fact_orders), _by_gmv(), F.col("customer_gmv"))
    return running.select(
        "customer_unique_id", "customer_gmv",
        (F.col("running").cast("double") / F.col("total").cast("double")).alias("cum_gmv_pct"),
        (F.col("position").cast("double") / F.col("n")).alias("cum_customer_pct"),
    )


def top_share(fact_orders: DataFrame, one_in: int = 5) -> DataFrame:
    """GMV share of the first 1/`one_in` of the customers (20 % by default)."""
    people = settled(customer_gmv(fact_orders), "customer-gmv")
    cut = rank.tuples_at_ranks(people, _by_gmv(), lambda n: [n // one_in])
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_by_gmv())])
    marked = people.withColumn("_top", key <= cut[0] if cut else F.lit(False))
    top = F.coalesce(F.sum(F.when(F.col("_top"), F.col("customer_gmv"))), F.lit(0))
    return marked.agg(
        (top.cast("double") / F.sum("customer_gmv").cast("double")).alias("top20_gmv_share"))


def order_gmv_quantiles(fact_orders: DataFrame) -> DataFrame:
    delivered = fact_orders.filter("is_delivered")
    spots = {"gmv_p95": 0.95, "gmv_p99": 0.99}
    most = delivered.agg(F.max("order_gmv").alias("gmv_max"))
    return C.beside(most, rank.quantiles(delivered, F.col("order_gmv"), spots))


def gmv_histogram(fact_orders: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins over the order GMV up to its 95th percentile.

    The last bin is closed. Bin numbers come from whole cents, so no rounding
    moves a value across an edge. Empty bins are kept.
    """
    counts = settled(rank.value_counts(fact_orders.filter("is_delivered"), F.col("order_gmv")),
                     "order-gmv")
    p95 = rank.quantiles_of_counts(counts, {"p95": 0.95})
    kept = (
        counts.withColumn("p95", p95.scalar())
        .filter(F.col("value").cast("double") <= F.col("p95"))
        .select((F.col("value") * 100).cast("long").alias("cents"), "weight"))
    ends = kept.agg(F.struct(F.min("cents").alias("lo"), F.max("cents").alias("hi")).alias("e"))
    lo, hi = F.col("e.lo"), F.col("e.hi")
    flat = lo == hi  # all values equal: the middle bin of a range of width 1
    number = F.when(flat, F.lit(bins // 2)).otherwise(F.least(
        C.int_div((F.col("cents") - lo) * bins, F.greatest(hi - lo, F.lit(1))),
        F.lit(bins - 1)))
    filled = kept.withColumn("e", ends.scalar()).groupBy(number.cast("int").alias("bin")).agg(
        F.sum("weight").alias("orders"))
    left = F.when(flat, lo / 100 - 0.5).otherwise(lo / 100)
    width = F.when(flat, F.lit(1.0)).otherwise((hi - lo) / 100) / bins
    every = ends.select("e", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.filter("e.lo IS NOT NULL").join(F.broadcast(filled), "bin", "left").select(
        "bin", (left + width * F.col("bin")).alias("bin_left"),
        (left + width * (F.col("bin") + 1)).alias("bin_right"),
        F.coalesce("orders", F.lit(0)).alias("orders"))


def category_rollup(category_monthly: DataFrame, top: int | None = None) -> DataFrame:
    """All-time sums per category, largest first; orders add up the months."""
    sums = (
        category_monthly.filter("category IS NOT NULL").groupBy("category")
        .agg(F.sum("category_gmv").alias("total_gmv"),
             F.sum("category_order_count").alias("total_orders"))
        .withColumn("category_aov", C.ratio(F.col("total_gmv"), F.col("total_orders")))
        .withColumn("total_gmv_million", F.col("total_gmv").cast("double") / 1_000_000)
    )
    order = [F.col("total_gmv").desc_nulls_last(), F.col("category")]
    return sums.orderBy(*order).limit(top) if top else sums


def unknown_share(category_monthly: DataFrame) -> DataFrame:
    gmv = F.col("category_gmv")
    unknown = F.coalesce(F.sum(F.when(F.col("category") == "Unknown", gmv)), F.lit(0))
    return category_monthly.filter("category IS NOT NULL").agg(
        (unknown.cast("double") / F.sum(gmv).cast("double")).alias("unknown_gmv_share"))


def retention_trend(retention_monthly: DataFrame) -> DataFrame:
    """Monthly rates with the display position of each metric."""
    codes = F.array(*[F.lit(c) for c in RETENTION_CODES])
    place = F.array_position(codes, F.col("metric_code")).cast("int")
    return retention_monthly.select(
        "report_month", place.alias("metric_order"), "metric_code", "repeat_purchase_rate"
    ).orderBy("report_month", "metric_order")


def kpi_trends(kpi_monthly: DataFrame) -> DataFrame:
    return kpi_monthly.select(
        "report_month", "total_orders", "gmv", "actual_payment", "aov", "delivery_delay_rate",
        "installment_usage_rate")
