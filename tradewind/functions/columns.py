"""Column expressions shared by the datasets. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_gmv(price: str = "price", freight: str = "freight_value") -> Column:
    return F.col(price) + F.coalesce(F.col(freight), F.lit(0))


def title_label(name: Column) -> Column:
    """Readable category: underscores to blanks, first letters upper-case."""
    return F.initcap(F.replace(F.coalesce(name, F.lit("unknown")), F.lit("_"), F.lit(" ")))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def pct2(part: Column, whole: Column) -> Column:
    """100 * part / whole with two decimals, half away from zero, for counts.

    Integer arithmetic, so that no binary fraction can tip a tie.
    """
    hundredths = int_div(part * 20000 + whole, whole * 2)
    return F.when(whole > 0, hundredths / F.lit(100.0))


def beside(one_row: DataFrame, other: DataFrame) -> DataFrame:
    """Columns of two one-row frames in one row, through a scalar subquery."""
    packed = other.select(F.struct("*").alias("_other"))
    return one_row.withColumn("_other", packed.scalar()).select(*one_row.columns, "_other.*")


def purchase_day(ts: str = "order_purchase_timestamp") -> Column:
    return F.col(ts).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_before(ts: Column, months: int) -> Column:
    """`ts` minus whole months; the day is clamped to the month's last."""
    return ts - F.expr(f"INTERVAL '{months}' MONTH")


def is_delivered(status: str = "order_status") -> Column:
    return F.col(status) == "delivered"


def past_average(column: Column, window, n: int) -> Column:
    """Mean of the previous `n` rows, NULL until there are `n` of them.

    `column` must be decimal or integral, which makes the sum exact.
    """
    frame = window.rowsBetween(-n, -1)
    return F.when(F.count(column).over(frame) == n, F.sum(column).over(frame).cast("double") / n)


def past_stddev(column: Column, window, n: int) -> Column:
    """Sample deviation of the previous `n` rows from exact decimal sums."""
    frame = window.rowsBetween(-n, -1)
    total = F.sum(column).over(frame).cast("decimal(19,2)")
    squares = F.sum((column * column).cast("decimal(36,4)")).over(frame)
    exact = (squares * n - total * total).cast("double")
    return F.when(
        F.count(column).over(frame) == n, F.sqrt(F.greatest(exact, F.lit(0.0)) / (n * (n - 1)))
    )
