"""Month-end intervals without range joins.

A report month ends at its last event. Rows relate to it by time (`before its
end`, `in the last N months`, `up to N months before its end`). Each relation is
an equi-join on the calendar month plus, for one boundary month, a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.session import settled


def _with_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("month", C.month_start(F.col(ts).cast("date")))


def month_ends(df: DataFrame, ts: str) -> DataFrame:
    """Calendar months with an event and the time of their last one.

    Stored, because callers read these few rows more than once.
    """
    months = _with_month(df.filter(F.col(ts).isNotNull()), ts).groupBy(
        F.col("month").alias("report_month")).agg(F.max(ts).alias("as_of"))
    return settled(months, "month-ends")


def up_to_month_end(df: DataFrame, ts: str) -> DataFrame:
    """Per month: rows before the month's end and the latest of them.

    Same as joining months to rows on `ts < month + 1 month`; here months are
    summed first and the few month rows are accumulated.
    """
    months = _with_month(df.filter(F.col(ts).isNotNull()), ts).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("latest"))
    upto = Window.partitionBy(F.lit(1)).orderBy("month").rowsBetween(
        Window.unboundedPreceding, 0)
    return months.select(
        F.col("month").alias("report_month"),
        F.max("latest").over(upto).alias("as_of"),
        F.sum("n").over(upto).alias("rows_before_end"))


def in_window(df: DataFrame, ts: str, member: str, months: int) -> DataFrame:
    """Per report month: rows and distinct members with `as_of - months < ts <= as_of`."""
    rows = _with_month(df.filter(F.col(ts).isNotNull()), ts)
    ends = month_ends(df, ts)
    bounds = ends.select(
        F.add_months("report_month", -months).alias("month"),
        C.months_before(F.col("as_of"), months).alias("lower"))
    # A member's month is one row before it is repeated for the report months.
    per_member = rows.join(F.broadcast(bounds), "month", "left").groupBy(member, "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(ts) > F.col("lower")).alias("n_edge"))  # bounds: one row per month
    spread = per_member.withColumn(
        "ahead", F.explode(F.sequence(F.lit(0), F.lit(months)))
    ).select(
        F.add_months("month", F.col("ahead")).alias("report_month"), member,
        F.when(F.col("ahead") == months, F.col("n_edge")).otherwise(F.col("n")).alias("n"),
    ).filter("n > 0")
    per_report = spread.groupBy("report_month", member).agg(F.sum("n").alias("n"))
    return (
        per_report.join(F.broadcast(ends), "report_month")  # one row per month
        .groupBy("report_month", "as_of")
        .agg(F.sum("n").alias("rows_in_window"), F.count(F.lit(1)).alias("members_in_window"))
    )


def before_window(df: DataFrame, ts: str, member: str, months: int) -> DataFrame:
    """Per report month: members with a row at `ts <= as_of - months`.

    A member counts from its first row on, so only first rows are compared, and
    only in the month that holds the bound.
    """
    first = _with_month(
        df.filter(F.col(ts).isNotNull()).groupBy(member).agg(F.min(ts).alias("first")), "first")
    ends = month_ends(df, ts)
    bounds = ends.select(
        "report_month", F.add_months("report_month", -months).alias("month"),
        C.months_before(F.col("as_of"), months).alias("bound"))
    edge = first.join(F.broadcast(bounds), "month").groupBy("report_month").agg(
        F.count_if(F.col("first") <= F.col("bound")).alias("edge"))  # one row per month
    new = first.groupBy("month").agg(F.count(F.lit(1)).alias("new"))
    # New members and bounds on one line of calendar months, added up to before each bound.
    number = F.year("month") * 12 + F.month("month")
    line = new.select(number.alias("m"), "new", F.lit(None).cast("date").alias("report_month")).unionByName(
        bounds.select(number.alias("m"), F.lit(0).cast("long").alias("new"), "report_month"))
    before = Window.partitionBy(F.lit(1)).orderBy("m").rangeBetween(Window.unboundedPreceding, -1)
    earlier = line.withColumn("earlier", F.sum("new").over(before)).filter(
        "report_month IS NOT NULL").select("report_month", "earlier")
    return ends.select("report_month").join(earlier, "report_month", "left").join(
        edge, "report_month", "left").select(
        "report_month",
        (F.coalesce("earlier", F.lit(0)) + F.coalesce("edge", F.lit(0))).alias("members_before"))
