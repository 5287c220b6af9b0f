"""Forecast pipeline. Every query that shows a trained result fits its forest; what SQL can
state of it (keys, dates, actual values, counts and identities) is compared."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind import session
from tradewind.forecast import features as X
from tradewind.forecast import model as M
from tradewind.forecast import recursive as R
from tradewind.forecast.run import Forecast, Settings
from tradewind.queries import query

# Queries that need a forest take the first setting of the declared grid.
ONE = {name: values[:1] for name, values in M.GRID.items()}


def daily(w):
    return X.daily_metrics(w["gold_fact_orders"])


def _by_state(w):
    places = w["raw_customers"].select("customer_id", "customer_state")
    return X.daily_metrics(
        w["gold_fact_orders"].join(places, "customer_id"), series="customer_state")


_runs: dict[tuple, Forecast] = {}


def forecast_of(w, grid=None, source=daily) -> Forecast:
    """The run over a warehouse; queries on one input share its forest, until its stored
    frames are cleared."""
    frame = source(w)
    key = (session.generation(w.spark), tuple(sorted(frame.inputFiles())), source.__name__,
           str(grid))
    if key not in _runs:
        if len(_runs) > 8:
            _runs.clear()
        _runs[key] = Forecast(frame, Settings(grid=grid or ONE, run_id="registered"))
    return _runs[key]


_SPINE = """(SELECT 'total' AS series, d AS order_date, first_date,
        coalesce(orders, 0) AS orders, coalesce(gmv, 0) AS gmv,
        coalesce(unique_customers, 0) AS unique_customers
    FROM (SELECT min(order_date) AS first_date, unnest(generate_series(min(order_date),
            max(order_date), INTERVAL 1 DAY))::DATE AS d FROM ml_daily_business_metrics) s
    LEFT JOIN ml_daily_business_metrics ON order_date = d)"""


@query("ml_daily_metrics", "SELECT * FROM ml_daily_business_metrics", "gmv")
def _(w):
    return daily(w)


@query("ml_daily_spine", f"SELECT * FROM {_SPINE}", "gmv")
def _(w):
    return X.daily_spine(daily(w))


def _feature_sql() -> str:
    columns = ["date_diff('day', first_date, order_date)::INT AS trend",
               "(isodow(order_date) - 1)::INT AS day_of_week",
               "month(order_date)::INT AS month", "quarter(order_date)::INT AS quarter",
               "round(sin(2 * pi() * month(order_date) / 12), 9) + 0.0 AS month_sin",
               "round(cos(2 * pi() * month(order_date) / 12), 9) + 0.0 AS month_cos"]
    columns += [f"(lag(gmv, {n}) OVER o)::DOUBLE AS gmv_lag_{n}" for n in X.GMV_LAGS]
    columns += [f"(sum(gmv) OVER (o ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING))::DOUBLE / {n} "
                f"AS gmv_rolling_mean_{n}" for n in X.MEANS]
    columns += ["round(stddev_samp(gmv::DOUBLE) OVER (o ROWS BETWEEN 3 PRECEDING AND "
                "1 PRECEDING), 3) AS gmv_rolling_std_3"]
    for n in X.OTHER_LAGS:
        columns += [f"(lag(orders, {n}) OVER o)::DOUBLE AS orders_lag_{n}",
                    f"(lag(unique_customers, {n}) OVER o)::DOUBLE AS customers_lag_{n}"]
    return (f"SELECT series, order_date, gmv::DOUBLE AS gmv, {', '.join(columns)} "
            f"FROM {_SPINE} s WINDOW o AS (ORDER BY order_date) "
            "QUALIFY row_number() OVER (ORDER BY order_date) > 28")


@query("ml_features", _feature_sql())
def _(w):
    rows = X.training_rows(X.add_features(X.daily_spine(daily(w))))

    def shown(name: str):
        digits = {"month_sin": 9, "month_cos": 9, "gmv_rolling_std_3": 3}.get(name)
        c = F.col(name)
        return (F.round(c, digits) + 0.0).alias(name) if digits else c

    return rows.select("series", "order_date", "gmv", *[shown(f) for f in X.FEATURES])


_ROWS = f"(SELECT order_date FROM {_SPINE} s QUALIFY row_number() OVER (ORDER BY order_date) > 28)"
_START = f"""(SELECT (date_trunc('month', max(order_date)) - INTERVAL 2 MONTH)::DATE
    FROM {_ROWS} r)"""


@query("ml_train_test_split", f"""
    SELECT CASE WHEN order_date < {_START} THEN 'train' ELSE 'test' END AS side,
        min(order_date) AS first_day, max(order_date) AS last_day, count(*) AS rows
    FROM {_ROWS} r GROUP BY 1""")
def _(w):
    rows = X.training_rows(X.add_features(X.daily_spine(daily(w))))
    return M.split_summary(*M.train_test_split(rows, 3))


@query("ml_timeseries_split", f"""
    SELECT f::INT AS fold, test_start, test_start + size AS test_end,
        (SELECT count(*) FROM {_ROWS} r WHERE order_date < test_start) AS train_rows,
        (SELECT count(*) FROM {_ROWS} r WHERE order_date >= test_start
            AND order_date < test_start + size) AS test_rows
    FROM (SELECT f, size, (SELECT order_date FROM (
              SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS i
              FROM {_ROWS} r WHERE order_date < {_START}) t
          WHERE i = n - (5 - f) * size) AS test_start
          FROM (SELECT unnest(range(5)) AS f) a, (SELECT count(*) AS n,
              (count(*) // 6)::INT AS size FROM {_ROWS} r WHERE order_date < {_START}) b) c""")
def _(w):
    rows = X.training_rows(X.add_features(X.daily_spine(daily(w))))
    return M.fold_sizes(M.train_test_split(rows, 3)[0])


# The value a week earlier as prediction, on days with sales.
@query("ml_regression_metrics", f"""
    SELECT round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae,
        round(avg(abs(y - p) / y), 6) AS mape,
        round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
    FROM (SELECT gmv::DOUBLE AS y, lag(gmv::DOUBLE, 7) OVER (ORDER BY order_date) AS p
          FROM {_SPINE} s) x WHERE y > 0 AND p IS NOT NULL""")
def _(w):
    week = Window.partitionBy("series").orderBy("order_date")
    naive = X.daily_spine(daily(w)).withColumn(
        "prediction", F.lag("gmv", 7).over(week).cast("double"))
    metrics = M.regression_metrics(naive.filter("gmv > 0 AND prediction IS NOT NULL"))
    digits = {"rmse": 3, "mae": 3, "mape": 6, "r2": 6}
    return metrics.select(*[F.round(c, n).alias(c) for c, n in digits.items()])


@query("ml_assumptions", f"""
    SELECT 'total' AS series, sum(gmv)::DOUBLE / sum(orders) AS aov,
        least(1.0, sum(unique_customers)::DOUBLE / sum(orders)) AS customer_ratio
    FROM (SELECT * FROM {_SPINE} s WHERE orders > 0 AND gmv > 0
          ORDER BY order_date DESC LIMIT 90) r""")
def _(w):
    return R.assumptions(X.daily_spine(daily(w)))


_FOLDS = f"""(SELECT least(5, greatest(2, count(*) // 60))::INT AS k, count(*) AS n
    FROM {_ROWS} r WHERE order_date < {_START})"""
_BEST = str(M.settings(ONE)[0]).replace("'", "''")


@query("ml_random_forest", f"""
    SELECT 'total' AS series, order_date, gmv::DOUBLE AS gmv, true AS predicted
    FROM {_SPINE} s WHERE order_date >= {_START}""", "gmv")
def _(w):
    return forecast_of(w).predictions().select(
        "series", "order_date", "gmv", (F.col("prediction") >= 0).alias("predicted"))


@query("ml_param_grid", f"""
    SELECT d AS max_depth, l AS min_samples_leaf, t AS n_estimators, f::INT AS fold,
        n - (k - f) * (n // (k + 1)) AS train_rows, n // (k + 1) AS test_rows
    FROM (SELECT unnest([6, 8, 10]) AS d) a, (SELECT unnest([2, 3, 5]) AS l) b,
        (SELECT unnest([200, 300, 500]) AS t) c,
        (SELECT k, n, unnest(range(k)) AS f FROM {_FOLDS} x) e""")
def _(w):
    """The declared grid on the folds of the rule: what a search fits and scores."""
    rows = X.training_rows(X.add_features(X.daily_spine(daily(w))))
    folds = M.fold_sizes(M.train_test_split(rows, 3)[0]).select("fold", "train_rows", "test_rows")
    grid = w.spark.createDataFrame(M.settings(M.GRID),
                                   "max_depth int, min_samples_leaf int, n_estimators int")
    return folds.withColumn("g", grid.agg(F.collect_list(F.struct("*"))).scalar()).select(
        F.inline("g"), "fold", "train_rows", "test_rows")


_SEARCH_ROWS = f"""(SELECT d, l, t, f::INT AS fold, k FROM (SELECT unnest([6, 8, 10]) AS d) a,
    (SELECT unnest([2, 3, 5]) AS l) b, (SELECT unnest([200, 300, 500]) AS t) c,
    (SELECT k, unnest(range(k)) AS f FROM {_FOLDS} x) e)"""


@query("ml_grid_search", f"""
    SELECT '{{''max_depth'': ' || d || ', ''min_samples_leaf'': ' || l || ', ''n_estimators'': '
        || t || '}}' AS setting, fold, true AS scored, true AS mean_of_folds, 1 AS best_settings
    FROM {_SEARCH_ROWS} s""")
def _(w):
    rows = forecast_of(w, M.GRID).search.as_rows(w.spark)
    own = Window.partitionBy("setting")
    best = rows.filter("is_best").agg(F.countDistinct("setting").cast("int"))
    lowest = rows.agg(F.min("mean_rmse"))
    return rows.select(
        "setting", "fold",
        ((F.col("rmse") > 0) & (F.col("is_best") == (F.col("mean_rmse") == lowest.scalar())))
        .alias("scored"),
        (F.abs(F.avg("rmse").over(own) - F.col("mean_rmse")) < 1e-6).alias("mean_of_folds"),
        best.scalar().alias("best_settings"))


@query("ml_tune", f"SELECT k AS cv_splits, count(*) AS fits, 3 * 3 * 3 AS settings "
                  f"FROM {_SEARCH_ROWS} s GROUP BY k")
def _(w):
    search = forecast_of(w, M.GRID).search
    return search.as_rows(w.spark).filter("rmse > 0 AND mean_rmse >= 0").agg(
        F.lit(search.splits).alias("cv_splits"), F.count(F.lit(1)).alias("fits"),
        F.countDistinct("setting").cast("int").alias("settings"))


_ROLES = """(VALUES ('primary_tuning', 'daily', 'rmse'), ('secondary_check', 'daily', 'mae'),
    ('secondary_check', 'daily', 'mape'), ('secondary_check', 'daily', 'r2'),
    ('business_eval', 'monthly', 'mae'), ('business_eval', 'monthly', 'mape'))
    AS v(metric_role, grain, metric)"""


@query("ml_evaluate", f"SELECT metric_role, grain, metric, true AS plausible FROM {_ROLES}")
def _(w):
    low = F.when(F.col("metric") == "r2", F.col("value") <= 1).otherwise(F.col("value") > 0)
    return forecast_of(w).evaluation().select("metric_role", "grain", "metric", low.alias("plausible"))


@query("ml_performance_table", f"""
    SELECT 'RandomForestRegressor' AS model, '{_BEST}' AS best_params,
        'last_3_calendar_months' AS test_split, 'TimeSeriesSplit' AS cv_method, k AS cv_splits,
        (SELECT min(order_date) FROM {_ROWS} r) AS train_start,
        ({_START} - INTERVAL 1 DAY)::DATE AS train_end, {_START} AS test_start,
        (SELECT max(order_date) FROM {_ROWS} r) AS test_end, n::INT AS train_rows,
        (SELECT count(*) FROM {_ROWS} r WHERE order_date >= {_START})::INT AS test_rows,
        3 AS monthly_test_rows, metric_role, grain, metric, true AS scored
    FROM {_ROLES}, {_FOLDS} f""")
def _(w):
    table = forecast_of(w).tables()["ml_rf_model_performance"]
    scored = (F.col("cv_best_daily_rmse") > 0) & F.col("value").isNotNull()
    return table.drop("forecast_run_id").withColumn("scored", scored).drop(
        "cv_best_daily_rmse", "value")


_NAMES = ", ".join(f"('{f}')" for f in X.FEATURES)


@query("ml_feature_importance", f"""
    SELECT feature, true AS is_share, 1.0::DOUBLE AS total FROM (VALUES {_NAMES}) AS v(feature)""")
def _(w):
    rows = forecast_of(w).importance()
    return rows.select(
        "feature", F.col("importance").between(0, 1).alias("is_share"),
        rows.agg(F.round(F.sum("importance"), 9)).scalar().alias("total"))


@query("ml_importance_table", """
    SELECT unnest(range(1, 21))::INT AS rank, 'RandomForestRegressor' AS model, true AS ordered""")
def _(w):
    table = forecast_of(w).tables()["ml_rf_feature_importance"]
    before = F.lag("importance").over(Window.partitionBy("model").orderBy("rank"))
    return table.select("rank", "model",
                        (F.col("importance") <= F.coalesce(before, F.lit(1))).alias("ordered"))


@query("ml_recursive_forecast", f"""
    SELECT 'total' AS series, d + i AS order_date, i AS forecast_step, true AS orders_fit,
        true AS customers_fit
    FROM (SELECT max(order_date) AS d FROM {_SPINE} s) x, (SELECT unnest(range(1, 31))::INT AS i) y""")
def _(w):
    run = forecast_of(w)
    near = lambda a, b: F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.lit(1.0))
    days = run.forecast_daily().join(R.assumptions(run.spine), "series")
    return days.select(
        "series", "order_date", "forecast_step",
        (near(F.col("forecast_orders"), F.col("forecast_gmv") / F.col("aov"))
         & (F.col("forecast_gmv") >= 0)).alias("orders_fit"),
        near(F.col("forecast_daily_unique_customers"),
             F.col("forecast_orders") * F.col("customer_ratio")).alias("customers_fit"))


@query("ml_forecast_monthly", """
    SELECT series, date_trunc('month', last + i)::DATE AS month_start, count(*)::INT AS forecast_days,
        true AS sums_fit
    FROM (SELECT customer_state AS series, min(order_purchase_date) AS first,
              any_value(last) AS last, count(*) FILTER (order_gmv > 0) AS sold
          FROM gold_fact_orders JOIN raw_customers USING (customer_id),
              (SELECT max(order_date) AS last FROM ml_daily_business_metrics) l
          WHERE is_delivered GROUP BY 1) s, (SELECT unnest(range(1, 31))::INT AS i) y
    WHERE last - first >= 27 AND sold > 0 GROUP BY 1, 2""")
def _(w):
    days = forecast_of(w, source=_by_state).forecast_daily()
    again = days.groupBy("series", F.trunc("order_date", "MM").alias("month_start")).agg(
        F.sum("forecast_gmv").alias("g"), F.sum("forecast_orders").alias("o"))
    return R.monthly(days).join(again, ["series", "month_start"]).select(
        "series", "month_start", "forecast_days",
        ((F.abs(F.col("g") - F.col("forecast_gmv")) <= 1e-6 * F.greatest("g", F.lit(1.0)))
         & (F.abs(F.col("o") - F.col("forecast_orders")) <= 1e-6 * F.greatest("o", F.lit(1.0))))
        .alias("sums_fit"))
