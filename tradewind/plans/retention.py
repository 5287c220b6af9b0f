"""Repeat-purchase metrics at one moment and at the end of every month.

Both work on delivered orders of persons. No range join: the end of a month's
window is the last order of that month, so an order belongs to the windows of
its own month and of the next few, and only the oldest of these needs a
comparison with the window's lower bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.schema import RETENTION_CODES
from tradewind.session import settled

WINDOWS = (3, 6)
_PERSON, _TS = "customer_unique_id", "order_purchase_timestamp"


def _orders(delivered: DataFrame) -> DataFrame:
    """Person, order and time, repeated rows removed."""
    return delivered.select(_PERSON, "order_id", _TS).distinct()


def _as_rows(wide: DataFrame, keys: list[str]) -> DataFrame:
    """(total_<code>, returning_<code>) columns to one row per metric code."""
    packed = F.array(*[
        F.struct(
            F.lit(code).alias("metric_code"),
            F.col(f"total_{code}").alias("total_customers"),
            F.col(f"returning_{code}").alias("returning_customers"),
        )
        for code in RETENTION_CODES
    ])
    rows = wide.select(*keys, F.explode(packed).alias("m")).select(*keys, "m.*")
    return rows.withColumn(
        "repeat_purchase_rate",
        C.ratio(F.col("returning_customers"), F.col("total_customers")))


def snapshot(delivered: DataFrame, dates: DataFrame) -> DataFrame:
    """Five metrics at the dataset's as-of moment, in one pass per person."""
    moment = dates.select("as_of_timestamp").scalar()
    orders = _orders(delivered).withColumn("as_of", moment).filter(F.col(_TS) <= F.col("as_of"))
    lower = {n: C.months_before(F.col("as_of"), n) for n in WINDOWS}
    # `as_of` is constant; max() only carries it through the aggregate.
    people = orders.groupBy(_PERSON).agg(
        F.countDistinct("order_id").alias("lifetime"),
        F.min(_TS).alias("first_ts"),
        F.max("as_of").alias("as_of"),
        *[F.count_if(F.col(_TS) > lower[n]).alias(f"in_{n}") for n in WINDOWS],
    )
    measures = {
        "total_lifetime_repeat_purchase": F.lit(True),
        "returning_lifetime_repeat_purchase": F.col("lifetime") > 1,
    }
    for n in WINDOWS:
        inside, before = F.col(f"in_{n}"), F.col("first_ts") <= lower[n]
        measures[f"total_last_{n}m_returning_customer"] = inside > 0
        measures[f"returning_last_{n}m_returning_customer"] = (inside > 0) & before
        measures[f"total_last_{n}m_repeat_purchase"] = inside > 0
        measures[f"returning_last_{n}m_repeat_purchase"] = inside > 1
    wide = (
        people.agg(*[F.count_if(c).alias(name) for name, c in measures.items()])
        .withColumn("as_of_timestamp", moment)
        .withColumn("as_of_date", F.col("as_of_timestamp").cast("date"))
    )
    return _as_rows(wide, ["as_of_date", "as_of_timestamp"])


def month_ends(delivered: DataFrame) -> DataFrame:
    """Calendar months with a delivered order and the last order time in each.

    Stored, because the metrics read these few rows three times.
    """
    ends = delivered.groupBy(C.month_start(F.col(_TS).cast("date")).alias("report_month")).agg(
        F.max(_TS).alias("as_of_timestamp"))
    return settled(ends, "month-ends")


def _person_months(delivered: DataFrame, ends: DataFrame) -> DataFrame:
    """Per person and month of purchase: orders, and those inside the oldest window.

    `in_n` counts the orders later than the lower bound of the window that ends
    `n` months later. Counting happens before rows of one person meet.
    """
    month = F.col("month")
    bounds = ends
    orders = _orders(delivered).withColumn("month", C.month_start(F.col(_TS).cast("date")))
    for n in WINDOWS:
        bounds = ends.select(
            F.add_months("report_month", -n).alias("month"),
            C.months_before(F.col("as_of_timestamp"), n).alias(f"lower_{n}"))
        # One row per calendar month.
        orders = orders.join(F.broadcast(bounds), "month", "left")
    return orders.groupBy(_PERSON, month).agg(
        F.count(F.lit(1)).alias("orders"),
        F.min(_TS).alias("first_in_month"),
        *[F.count_if(F.col(_TS) > F.col(f"lower_{n}")).alias(f"in_{n}") for n in WINDOWS],
    )


def monthly(delivered: DataFrame) -> DataFrame:
    """Five metrics for every month, each at that month's last order."""
    ends = month_ends(delivered)
    mine = Window.partitionBy(_PERSON)
    upto = mine.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    # A person has at most one row per calendar month here.
    people = (
        _person_months(delivered, ends)
        .withColumn("first_ts", F.min("first_in_month").over(mine))
        .withColumn("so_far", F.sum("orders").over(upto))
        .withColumn("starts", (F.col("so_far") == F.col("orders")).cast("long"))
        .withColumn(
            "repeats",
            ((F.col("so_far") > 1) & (F.col("so_far") - F.col("orders") <= 1)).cast("long"))
    )
    span = max(WINDOWS)
    ahead = F.col("ahead")

    def counted(n: int) -> Column:
        return F.when(ahead < n, F.col("orders")).when(ahead == n, F.col(f"in_{n}")).otherwise(0)

    here = ahead == 0
    exploded = people.withColumn("ahead", F.explode(F.sequence(F.lit(0), F.lit(span)))).select(
        _PERSON,
        F.add_months("month", ahead).alias("report_month"),
        "first_ts",
        F.when(here, F.col("starts")).otherwise(0).alias("starts"),
        F.when(here, F.col("repeats")).otherwise(0).alias("repeats"),
        *[counted(n).alias(f"n_{n}") for n in WINDOWS],
    )
    # Rows of one person are already in one task, so this adds no exchange.
    per_person = exploded.groupBy(_PERSON, "report_month").agg(
        F.min("first_ts").alias("first_ts"),
        F.max("starts").alias("starts"),
        F.max("repeats").alias("repeats"),
        *[F.sum(f"n_{n}").alias(f"n_{n}") for n in WINDOWS],
    )
    measures = [F.sum("starts").alias("new_people"), F.sum("repeats").alias("new_repeaters")]
    for n in WINDOWS:
        inside = F.col(f"n_{n}")
        before = F.col("first_ts") <= C.months_before(F.col("as_of_timestamp"), n)
        measures += [
            F.count_if(inside > 0).alias(f"total_last_{n}m_returning_customer"),
            F.count_if((inside > 0) & before).alias(f"returning_last_{n}m_returning_customer"),
            F.count_if(inside > 0).alias(f"total_last_{n}m_repeat_purchase"),
            F.count_if(inside > 1).alias(f"returning_last_{n}m_repeat_purchase"),
        ]
    by_month = (
        per_person.join(F.broadcast(ends), "report_month")  # one row per calendar month
        .groupBy("report_month", "as_of_timestamp")
        .agg(*measures)
    )
    # Running totals over calendar months, a handful of rows.
    history = Window.partitionBy(F.lit(1)).orderBy("report_month").rowsBetween(
        Window.unboundedPreceding, 0)
    wide = by_month.withColumn(
        "total_lifetime_repeat_purchase", F.sum("new_people").over(history)
    ).withColumn("returning_lifetime_repeat_purchase", F.sum("new_repeaters").over(history))
    return _as_rows(wide, ["report_month", "as_of_timestamp"])
