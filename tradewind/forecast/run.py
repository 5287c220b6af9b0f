"""The forecast run: daily series -> tuned forest -> five output tables."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import schema
from tradewind.forecast import features as X
from tradewind.forecast import model as M
from tradewind.forecast import recursive as R
from tradewind.functions import columns as C
from tradewind.session import settled
from tradewind.sources import sinks
from tradewind.sources.snapshots import Snapshots

MODEL = "RandomForestRegressor"


@dataclass
class Settings:
    test_months: int = 3
    horizon_days: int = 30
    assumption_window: int = 90
    grid: dict[str, list] = field(default_factory=lambda: dict(M.GRID))
    splits: int | None = None
    seed: int = M.SEED
    max_bins: int = M.MAX_BINS
    run_id: str | None = None


class Forecast:
    """One run over a daily series frame (`daily_metrics`).

    Without a `series` column there is one series, and the output tables have
    exactly the declared columns; with it they carry the series as well.
    """

    def __init__(self, daily: DataFrame, settings: Settings | None = None):
        self.settings = settings or Settings()
        self.spark = daily.sparkSession
        self.run_id = self.settings.run_id or uuid.uuid4().hex
        self.generated_at = dt.datetime.now(dt.timezone.utc)
        self.daily = daily
        self.by_series = ["series"] if "series" in daily.columns else []
        self.spine = settled(X.daily_spine(daily), "daily-spine")
        rows = M.assembled(X.training_rows(X.add_features(self.spine)))
        self.rows = settled(rows, "training-rows")
        self.train, self.test = M.train_test_split(self.rows, self.settings.test_months)
        self._search: M.Search | None = None
        self._model: M.Forest | None = None

    @property
    def _checked_train(self) -> DataFrame:
        M.checked_extent(self.train, "train")
        M.checked_extent(self.test, "test")
        return settled(self.train, "train")

    @property
    def search(self) -> M.Search:
        if self._search is None:
            s = self.settings
            self._search = M.grid_search(
                self._checked_train, s.grid, s.splits, s.seed, s.max_bins, self._model)
            self._model = self._search.model
        return self._search

    @property
    def model(self) -> M.Forest:
        """The chosen forest. With a single setting there is nothing to choose: it is fitted
        once, and folds are only run by whoever asks for their score."""
        if self._model is None:
            s, all_settings = self.settings, M.settings(self.settings.grid)
            if len(all_settings) == 1:
                self._model = M.fit(self._checked_train, all_settings[0], s.seed, s.max_bins)
            else:
                return self.search.model
        return self._model

    def predictions(self) -> DataFrame:
        """The holdout with its predictions."""
        return self.model.transform(self.test).select(
            "series", "order_date", "gmv", "prediction")

    def evaluation(self) -> DataFrame:
        """(metric_role, grain, metric, value): six rows."""
        predicted = settled(self.predictions(), "holdout")
        months = M.monthly_totals(predicted)
        daily, monthly = M.regression_metrics(predicted), M.regression_metrics(months)
        wide = C.beside(daily, monthly.select(
            F.col("mae").alias("month_mae"), F.col("mape").alias("month_mape")))
        rows = [("primary_tuning", "daily", "rmse", "rmse"),
                ("secondary_check", "daily", "mae", "mae"),
                ("secondary_check", "daily", "mape", "mape"),
                ("secondary_check", "daily", "r2", "r2"),
                ("business_eval", "monthly", "mae", "month_mae"),
                ("business_eval", "monthly", "mape", "month_mape")]
        return wide.select(F.explode(F.array(*[
            F.struct(F.lit(role).alias("metric_role"), F.lit(grain).alias("grain"),
                     F.lit(metric).alias("metric"), F.col(source).alias("value"))
            for role, grain, metric, source in rows
        ])).alias("r")).select("r.*")

    def metrics_pivot(self) -> DataFrame:
        """One row per metric role, one column per grain and metric."""
        named = self.evaluation().withColumn("grain_metric", F.concat_ws("_", "grain", "metric"))
        columns = ["daily_mae", "daily_mape", "daily_r2", "daily_rmse", "monthly_mae",
                   "monthly_mape"]
        return named.groupBy("metric_role").pivot("grain_metric", columns).agg(F.first("value"))

    def performance(self) -> DataFrame:
        train, test = M.checked_extent(self.train, "train"), M.checked_extent(self.test, "test")
        months = self.test.select(
            "series", F.trunc("order_date", "MM").alias("m")).distinct().agg(
            F.count(F.lit(1)).cast("int").alias("n"))
        constant = {
            "forecast_run_id": self.run_id,
            "model": MODEL,
            "best_params": str(self.search.best),
            "test_split": f"last_{self.settings.test_months}_calendar_months",
            "cv_method": "TimeSeriesSplit",
            "cv_splits": self.search.splits,
            "cv_best_daily_rmse": self.search.best_rmse,
            "train_start": train["first_day"],
            "train_end": train["last_day"],
            "test_start": test["first_day"],
            "test_end": test["last_day"],
            "train_rows": train["rows"],
            "test_rows": test["rows"],
        }
        return self.evaluation().select(
            *[F.lit(v).alias(k) for k, v in constant.items()],
            months.scalar().alias("monthly_test_rows"),
            "metric_role", "grain", "metric", "value")

    def _stamped(self, df: DataFrame) -> DataFrame:
        return df.withColumn("forecast_run_id", F.lit(self.run_id)).withColumn(
            "generated_at", F.lit(self.generated_at)).withColumn("model", F.lit(MODEL))

    def importance(self) -> DataFrame:
        rows = self.spark.createDataFrame(
            M.importance(self.model), "rank int, feature string, importance double")
        return self._stamped(rows).select(
            "forecast_run_id", "generated_at", "model", "rank", "feature", "importance")

    def forecast_daily(self) -> DataFrame:
        s = self.settings
        made = R.forecast(self.spine, self.model, s.horizon_days, s.assumption_window)
        return self._stamped(settled(made, "forecast-daily"))

    def rejects(self) -> DataFrame:
        """(series, reason) of the series without a forecast."""
        return R.rejects(self.spine, self.settings.assumption_window)

    def tables(self) -> dict[str, DataFrame]:
        """The five output tables by name, with their declared columns and types."""
        days = self.forecast_daily()
        made = {
            "ml_daily_business_metrics": self.daily,
            "ml_forecast_result_daily": days,
            "ml_forecast_result_monthly": R.monthly(days),
            "ml_rf_model_performance": self.performance(),
            "ml_rf_feature_importance": self.importance(),
        }
        return {
            name: df.select(
                *[c for c in self.by_series if c in df.columns],
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.ML[name].fields])
            for name, df in made.items()
        }

    def write(self, folder: str) -> dict[str, DataFrame]:
        """Store the tables, and `ml_forecast_rejects`, and replace all of them at the same
        moment. The keys and NULLs of all are checked before."""
        ready = {name: settled(df, name) for name, df in self.tables().items()}
        broken = []
        for name, df in ready.items():
            key = schema.ML_KEYS[name] + [c for c in self.by_series if c in df.columns]
            broken += [(name, *row) for row in
                       sinks.violations(df, schema.ML[name].names, key)]
        if broken:
            raise ValueError(f"constraints violated: {broken}")
        store = Snapshots(self.spark, folder)
        made = store.write(ready | {"ml_forecast_rejects": self.rejects()})
        store.vacuum()
        return made
