"""Multi-step forecast in which each prediction feeds the next day's lags.

Steps follow one another, series are independent. The state of a series is one
row: its last 28 GMV values and last 7 order and customer counts as arrays. A
step is a narrow projection over all series; nothing is shuffled. The state is written
after every step: steps in one stage would each hold a Python worker of their own in
every task.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.forecast import features as X
from tradewind.functions import columns as C
from tradewind.session import settled

DEPTH = max(X.MEANS)


def assumptions(spine: DataFrame, window: int = 90) -> DataFrame:
    """Per series: order value and customers per order over its last `window`
    days with sales. The ratio is kept within [0, 1]."""
    recent = Window.partitionBy("series").orderBy(F.col("order_date").desc())
    days = (
        spine.filter("orders > 0 AND gmv > 0")
        .withColumn("place", F.row_number().over(recent))
        .filter(F.col("place") <= window)
    )
    orders = F.sum("orders")
    ratio = F.sum("unique_customers").cast("double") / orders
    return days.groupBy("series").agg(
        (F.sum("gmv").cast("double") / orders).alias("aov"),
        F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1.0)).alias("customer_ratio"))


def initial_state(spine: DataFrame) -> DataFrame:
    """One row per series: dates and the newest values, oldest first."""
    last = spine.agg(F.max("order_date").alias("d"))
    newest = spine.withColumn("last_date", last.scalar()).filter(
        F.datediff("last_date", "order_date") < DEPTH)
    days = F.array_sort(F.collect_list(F.struct(
        "order_date", F.col("gmv").cast("double").alias("g"),
        F.col("orders").cast("double").alias("o"),
        F.col("unique_customers").cast("double").alias("c"))))
    return (
        newest.groupBy("series", "first_date", "last_date")
        .agg(days.alias("days"))  # at most 28 entries
        .select(
            "series", "first_date", "last_date",
            F.transform("days", lambda d: d["g"]).alias("gmv"),
            F.transform("days", lambda d: d["o"]).alias("orders"),
            F.transform("days", lambda d: d["c"]).alias("customers"))
    )


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + term(v))


def step_features(day: Column) -> dict[str, Column]:
    """The features of the day after the state's last one."""
    gmv = F.col("gmv")
    out = X.calendar(day, F.col("first_date"))
    for n in X.GMV_LAGS:
        out[f"gmv_lag_{n}"] = F.element_at(gmv, -n)
    for n in X.MEANS:
        out[f"gmv_rolling_mean_{n}"] = _sum(F.slice(gmv, -n, n), lambda v: v) / n
    n = X.STD
    near = F.slice(gmv, -n, n)
    mean = _sum(near, lambda v: v) / n
    out[f"gmv_rolling_std_{n}"] = F.sqrt(_sum(near, lambda v: (v - mean) * (v - mean)) / (n - 1))
    for n in X.OTHER_LAGS:
        out[f"orders_lag_{n}"] = F.element_at("orders", -n)
        out[f"customers_lag_{n}"] = F.element_at("customers", -n)
    return out


def _push(array: str, value: Column) -> Column:
    return F.concat(F.slice(F.col(array), 2, DEPTH - 1), F.array(value))


def _state(spine: DataFrame, window: int) -> DataFrame:
    return initial_state(spine).join(assumptions(spine, window), "series", "left")


def _reason() -> Column:
    """Why a series cannot be forecast; null if it can."""
    return (F.when(F.size("gmv") < DEPTH, F.concat(
        F.lit("days of history: "), F.size("gmv").cast("string"), F.lit(f" of {DEPTH}")))
        .when(F.col("aov").isNull(), F.lit("no recent day with positive orders and GMV")))


def rejects(spine: DataFrame, window: int = 90) -> DataFrame:
    """(series, reason) of the series that `forecast` leaves out."""
    return _state(spine, window).select("series", _reason().alias("reason")).filter(
        "reason IS NOT NULL")


def forecast(
    spine: DataFrame, model, horizon: int = 30, window: int = 90
) -> DataFrame:
    """(series, order_date, forecast_step, forecast_gmv, forecast_orders,
    forecast_daily_unique_customers) for the days after the last one.

    Series with a short history or without a recent sale have no rows, see `rejects`; it is
    an error if that leaves none.
    """
    state = _state(spine, window).filter(_reason().isNull())
    state = settled(state.withColumn("made", F.array().cast(
        "array<struct<step:int,day:date,g:double,o:double,c:double>>")), "forecast-state")
    if state.isEmpty():
        raise ValueError(f"no series has {DEPTH} days of history and a recent day with "
                         "positive orders and GMV")
    # The same expressions serve every step: the state holds its own last day.
    vector = VectorAssembler(inputCols=X.FEATURES, outputCol="features")
    day = F.date_add("last_date", 1)
    inputs = step_features(day)
    read = ["*", *[inputs[f].cast("double").alias(f) for f in X.FEATURES]]
    g, o, c = F.col("g"), F.col("o"), F.col("c")
    gmv = F.greatest(F.lit(0.0), F.col("prediction")).alias("g")
    orders = (g / F.col("aov")).alias("o")
    customers = (o * F.col("customer_ratio")).alias("c")
    entry = F.struct((F.size("made") + 1).alias("step"), day.alias("day"), g, o, c)
    kept = state.columns
    following = {
        **{k: F.col(k) for k in kept}, "last_date": day, "gmv": _push("gmv", g),
        "orders": _push("orders", o), "customers": _push("customers", c),
        "made": F.concat("made", F.array(entry)),
    }
    advance = [column.alias(k) for k, column in following.items()]
    for _ in range(horizon):
        scored = model.transform(vector.transform(state.select(*read)))
        state = settled(
            scored.select(*kept, gmv).select("*", orders).select("*", customers)
            .select(*advance), "forecast-state")
    return state.select("series", F.inline("made")).select(
        "series",
        F.col("day").alias("order_date"),
        F.col("step").alias("forecast_step"),
        F.col("g").alias("forecast_gmv"),
        F.col("o").alias("forecast_orders"),
        F.col("c").alias("forecast_daily_unique_customers"))


def monthly(daily: DataFrame) -> DataFrame:
    """Sums per calendar month. Customers add up the daily counts, so a buyer on
    two days counts twice."""
    keys = [c for c in ("series", "forecast_run_id", "generated_at", "model")
            if c in daily.columns]
    return daily.groupBy(*keys, C.month_start(F.col("order_date")).alias("month_start")).agg(
        F.sum("forecast_gmv").alias("forecast_gmv"),
        F.sum("forecast_orders").alias("forecast_orders"),
        F.sum("forecast_daily_unique_customers").alias("forecast_daily_unique_customers_sum"),
        F.count(F.lit(1)).cast("int").alias("forecast_days"))
