"""Series, features, folds, metrics and the recursive forecast."""

import datetime as dt
import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind import schema
from tradewind.forecast import features as X
from tradewind.forecast import model as M
from tradewind.forecast import recursive as R
from tradewind.forecast.run import Forecast, Settings
from tradewind.sources import readers, sinks

DAY0 = dt.date(2018, 1, 1)
SMALL = {"n_estimators": [5, 10], "max_depth": [3], "min_samples_leaf": [2]}


def series(name, days, seed, skip=()):
    """A noisy weekly series; `skip` days have no row, day 60 has zero GMV."""
    rnd = random.Random(seed)
    out = []
    for i in range(days):
        if i in skip:
            continue
        orders = 5 + i % 7 + rnd.randrange(4)
        gmv = Decimal(0) if i == 60 else Decimal(orders * 100 + rnd.randrange(5000)) / 4
        out.append((name, DAY0 + dt.timedelta(i), orders, gmv, orders - i % 2))
    return out


@pytest.fixture(scope="module")
def daily(spark):
    rows = series("a", 160, 1, skip=(40, 41, 100)) + series("b", 150, 2)
    return spark.createDataFrame(
        rows, "series string, order_date date, orders long, gmv decimal(18,2), "
        "unique_customers long")


@pytest.fixture(scope="module")
def run(daily):
    return Forecast(daily, Settings(
        test_months=1, horizon_days=12, grid=SMALL, splits=2, run_id="r1"))


def test_spine_is_continuous(daily):
    rows = X.daily_spine(daily).collect()
    for name, first in (("a", DAY0), ("b", DAY0)):
        days = sorted(r["order_date"] for r in rows if r["series"] == name)
        assert days == [first + dt.timedelta(i) for i in range(160)]  # one common last day
    gap = next(r for r in rows if r["series"] == "a" and r["order_date"] == DAY0 + dt.timedelta(40))
    assert (gap["orders"], gap["gmv"], gap["unique_customers"]) == (0, Decimal("0.00"), 0)


def test_features(daily):
    rows = X.add_features(X.daily_spine(daily)).filter("series = 'a'").orderBy(
        "order_date").collect()
    gmv = [float(r["gmv"]) for r in rows]
    for i in (28, 75, 159):
        r = rows[i]
        assert r["trend"] == i and r["day_of_week"] == r["order_date"].weekday()
        assert r["month_sin"] == pytest.approx(math.sin(2 * math.pi * r["month"] / 12))
        for n in X.GMV_LAGS:
            assert r[f"gmv_lag_{n}"] == gmv[i - n]
        for n in X.MEANS:
            assert r[f"gmv_rolling_mean_{n}"] == pytest.approx(sum(gmv[i - n:i]) / n)
        assert r["gmv_rolling_std_3"] == pytest.approx(statistics.stdev(gmv[i - 3:i]))
    assert rows[27]["gmv_rolling_mean_28"] is None
    assert X.training_rows(X.add_features(X.daily_spine(daily))).count() == 2 * (160 - 28)


def test_step_features_equal_window_features(daily):
    """The state's next-day features are those a window gives to an added day."""
    spine = X.daily_spine(daily)
    last = DAY0 + dt.timedelta(159)
    state = R.initial_state(spine.filter(F.col("order_date") < F.lit(last)))
    day = F.date_add("last_date", 1)
    made = R.step_features(day)
    steps = {r["series"]: r for r in state.select(
        "series", *[made[f].cast("double").alias(f) for f in X.FEATURES]).collect()}
    windows = X.add_features(spine).filter(F.col("order_date") == F.lit(last)).collect()
    assert len(windows) == 2
    for row in windows:
        for f in X.FEATURES:
            assert steps[row["series"]][f] == pytest.approx(float(row[f]), rel=1e-12), f


def test_holdout_and_folds(run):
    assert M.holdout_start(run.rows, 1).first()["test_start"] == dt.date(2018, 6, 1)
    sides = {r["side"]: r for r in M.split_summary(run.train, run.test).collect()}
    assert sides["train"]["last_day"] == dt.date(2018, 5, 31)
    assert sides["test"]["first_day"] == dt.date(2018, 6, 1)
    n = (dt.date(2018, 5, 31) - (DAY0 + dt.timedelta(28))).days + 1
    folds = M.fold_bounds(run.train, 3).orderBy("fold").collect()
    size = n // 4
    first = DAY0 + dt.timedelta(28)
    for i, f in enumerate(folds):
        assert f["test_start"] == first + dt.timedelta(n - (3 - i) * size)
        assert f["test_end"] == f["test_start"] + dt.timedelta(size)
    assert folds[-1]["test_end"] == dt.date(2018, 6, 1)


def test_fold_count_rule(spark):
    df = spark.createDataFrame([(59,), (130,), (400,), (2000,)], "n int")
    assert [r[0] for r in df.select(M.splits_for(F.col("n"))).collect()] == [2, 2, 5, 5]


def test_empty_side_is_an_error(daily):
    short = Forecast(daily, Settings(test_months=12, grid=SMALL, run_id="x"))
    with pytest.raises(ValueError, match="train side"):
        short.search


def test_metrics(spark):
    df = spark.createDataFrame(
        [(100.0, 90.0), (0.0, 5.0), (50.0, 50.0)], "gmv double, prediction double")
    m = M.regression_metrics(df).first()
    assert m["rmse"] == pytest.approx(math.sqrt(125 / 3))
    assert m["mae"] == pytest.approx(5.0)
    assert m["mape"] == pytest.approx((0.1 + 5 / M.EPSILON) / 3)
    assert m["r2"] == pytest.approx(1 - 125 / 5000)


def test_grid_order():
    assert len(M.settings(M.GRID)) == 27
    assert M.settings(SMALL)[0] == {"max_depth": 3, "min_samples_leaf": 2, "n_estimators": 5}


def test_search(run):
    search = run.search
    assert len(search.scores) == 4 and search.splits == 2
    means = M._means(search.scores)
    assert search.best_rmse == min(means.values())
    ranked = M.importance(search.model)
    assert [r for r, _, _ in ranked] == list(range(1, 21))
    assert sum(v for _, _, v in ranked) == pytest.approx(1.0)
    assert {f for _, f, _ in ranked} == set(X.FEATURES)


def test_assumptions(daily):
    got = {r["series"]: r for r in R.assumptions(X.daily_spine(daily), 90).collect()}
    sold = [r for r in sorted(series("b", 150, 2), key=lambda r: r[1]) if r[2] > 0 and r[3] > 0]
    recent = sold[-90:]
    orders = sum(r[2] for r in recent)
    assert got["b"]["aov"] == pytest.approx(float(sum(r[3] for r in recent)) / orders)
    assert got["b"]["customer_ratio"] == pytest.approx(sum(r[4] for r in recent) / orders)


def test_recursive_forecast(run):
    days = run.forecast_daily().orderBy("series", "order_date").collect()
    assert len(days) == 2 * 12
    assert {r["series"] for r in days} == {"a", "b"}
    for r in days:
        assert r["order_date"] == DAY0 + dt.timedelta(159 + r["forecast_step"])
        assert r["forecast_gmv"] >= 0 and r["forecast_orders"] >= 0
        assert r["forecast_daily_unique_customers"] <= r["forecast_orders"] + 1e-9
    again = run.forecast_daily().orderBy("series", "order_date").collect()
    assert [r["forecast_gmv"] for r in again] == [r["forecast_gmv"] for r in days]
    months = R.monthly(run.forecast_daily()).collect()
    assert sum(r["forecast_days"] for r in months) == 24
    assert sum(r["forecast_gmv"] for r in months) == pytest.approx(
        sum(r["forecast_gmv"] for r in days))


def test_steps_do_not_share_a_stage(run, monkeypatch):
    """Each Python step in a stage holds a worker of its own in every task."""
    plans, settled = [], R.settled

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settled(df, name)

    monkeypatch.setattr(R, "settled", watched)
    plans.append(R.forecast(run.spine, run.model, 4)._jdf.queryExecution().executedPlan().toString())
    assert max(p.count("ArrowEvalPython") for p in plans) == 1
    assert sum(p.count("ArrowEvalPython") for p in plans) == 4


def test_forecast_equals_full_recomputation(run, daily):
    """Appending each predicted day to the history and recomputing all features
    gives the same path."""
    made = {(r["series"], r["forecast_step"]): r for r in run.forecast_daily().collect()}
    spine = X.daily_spine(daily)
    for step in (1, 2, 3):
        known = [(s, r["order_date"], r["forecast_orders"], r["forecast_gmv"],
                  r["forecast_daily_unique_customers"])
                 for (s, k), r in made.items() if k < step]
        day = DAY0 + dt.timedelta(159 + step)
        history = spine.select(
            "series", "order_date", "first_date", F.col("orders").cast("double").alias("orders"),
            F.col("gmv").cast("double").alias("gmv"),
            F.col("unique_customers").cast("double").alias("unique_customers"))
        if known:
            past = spine.sparkSession.createDataFrame(
                known, "series string, order_date date, orders double, gmv double, "
                "unique_customers double").withColumn("first_date", F.lit(DAY0))
            history = history.unionByName(past)
        newest = history.groupBy("series", "first_date").agg(F.array_sort(F.collect_list(
            F.struct("order_date", "gmv", "orders", "unique_customers"))).alias("d"))
        state = newest.select(
            "series", "first_date", F.lit(day - dt.timedelta(1)).alias("last_date"),
            *[F.slice(F.transform("d", lambda x: x[c]), -28, 28).alias(a) for c, a in
              (("gmv", "gmv"), ("orders", "orders"), ("unique_customers", "customers"))])
        inputs = R.step_features(F.date_add("last_date", 1))
        rows = state.select("series", *[inputs[f].cast("double").alias(f) for f in X.FEATURES])
        from pyspark.ml.feature import VectorAssembler
        scored = run.model.transform(
            VectorAssembler(inputCols=X.FEATURES, outputCol="features").transform(rows))
        for r in scored.collect():
            assert max(0.0, r["prediction"]) == pytest.approx(
                made[r["series"], step]["forecast_gmv"], rel=1e-9)


def test_unusable_series_are_listed(spark, run):
    schema_text = ("series string, order_date date, orders long, gmv decimal(18,2), "
                   "unique_customers long")
    new = [("new", DAY0 + dt.timedelta(55), 3, Decimal("9.00"), 3)]
    idle = [("idle", DAY0 + dt.timedelta(i), 0, Decimal(0), 0) for i in range(60)]
    mixed = X.daily_spine(spark.createDataFrame(series("a", 60, 1) + new + idle, schema_text))
    assert {r["series"] for r in R.forecast(mixed, run.model, 2).collect()} == {"a"}
    assert {r["series"]: r["reason"] for r in R.rejects(mixed).collect()} == {
        "new": "days of history: 5 of 28", "idle": "no recent day with positive orders and GMV"}
    with pytest.raises(ValueError, match="no series"):
        R.forecast(X.daily_spine(spark.createDataFrame(new, schema_text)), run.model, 2)


def test_too_few_days_for_the_folds(spark):
    days = spark.createDataFrame([(DAY0 + dt.timedelta(i),) for i in range(4)], "order_date date")
    with pytest.raises(Exception, match="4 training days are too few for 5 folds"):
        M.fold_bounds(days, 5).collect()
    assert M.fold_bounds(days, 3).count() == 3


def test_smaller_forests_are_parts_of_the_largest(run):
    rows = run.train
    whole = M.fit(rows, {"n_estimators": 6, "max_depth": 3, "min_samples_leaf": 2})
    first = M.fit(rows, {"n_estimators": 2, "max_depth": 3, "min_samples_leaf": 2})
    both = whole.by_size(rows, {"few": 2, "all": 6}).select("order_date", "series", "few", "all")
    alone = {(r["series"], r["order_date"]): r["prediction"] for r in first.transform(rows).collect()}
    assert all(r["few"] == alone[r["series"], r["order_date"]] for r in both.collect())
    assert whole.trees == 6 and sum(whole.importances()) == pytest.approx(1)


def test_a_violation_changes_no_stored_table(daily, tmp_path):
    small = {"n_estimators": [2], "max_depth": [2], "min_samples_leaf": [2]}
    once = Forecast(daily, Settings(test_months=1, horizon_days=2, splits=2, run_id="r3", grid=small))
    once.write(str(tmp_path))
    before = {t: readers.table_scan(once.spark, f"{tmp_path}/{t}").collect() for t in schema.ML}
    again = Forecast(daily, Settings(test_months=1, horizon_days=2, splits=2, run_id="r4", grid=small))
    doubled = again.importance()
    again.importance = lambda: doubled.union(doubled)
    with pytest.raises(ValueError, match="ml_rf_feature_importance"):
        again.write(str(tmp_path))
    for table, rows in before.items():
        assert readers.table_scan(once.spark, f"{tmp_path}/{table}").collect() == rows
        assert [f.dataType for f in readers.table_scan(again.spark, f"{tmp_path}/{table}").schema.fields
                if f.name != "series"] == [f.dataType for f in schema.ML[table].fields]


def test_single_series_tables_survive_csv(daily, tmp_path):
    total = daily.groupBy("order_date").agg(
        F.sum("orders").alias("orders"), F.sum("gmv").alias("gmv"),
        F.sum("unique_customers").alias("unique_customers"))
    one = Forecast(total, Settings(
        test_months=1, horizon_days=2, splits=2, run_id="r2",
        grid={"n_estimators": [3], "max_depth": [2], "min_samples_leaf": [2]}))
    for name, df in one.tables().items():
        assert df.columns == schema.ML[name].names
        path = sinks.csv_export(df, str(tmp_path / name))
        back = readers.ml_csv(df.sparkSession, name, path)
        assert back.schema == schema.ML[name]
        broken = sinks.constraint_violations(back, schema.ML[name].names, schema.ML_KEYS[name])
        assert broken.filter("violations > 0").count() == 0
        assert back.count() == df.count() > 0


def test_output_tables(run, tmp_path):
    tables = run.write(str(tmp_path))
    performance = tables["ml_rf_model_performance"].collect()
    assert {(r["metric_role"], r["grain"], r["metric"]) for r in performance} == {
        ("primary_tuning", "daily", "rmse"), ("secondary_check", "daily", "mae"),
        ("secondary_check", "daily", "mape"), ("secondary_check", "daily", "r2"),
        ("business_eval", "monthly", "mae"), ("business_eval", "monthly", "mape")}
    assert performance[0]["test_split"] == "last_1_calendar_months"
    assert tables["ml_rf_feature_importance"].count() == 20
    pivot = {r["metric_role"]: r for r in run.metrics_pivot().collect()}
    assert pivot["primary_tuning"]["daily_rmse"] > 0
    assert pivot["business_eval"]["daily_rmse"] is None


def test_clearing_between_two_queries_starts_a_new_run(spark):
    from tradewind import queries, session

    queries.load_all()
    folder = "/root/testdata/sf0.001"
    first = queries.run("ml_random_forest", spark, folder).collect()
    assert session.clear(spark) > 0
    assert queries.run("ml_importance_table", spark, folder).count() == 20
    assert sorted(queries.run("ml_random_forest", spark, folder).collect()) == sorted(first)
