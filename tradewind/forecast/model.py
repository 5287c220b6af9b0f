"""Random-forest tuning and evaluation on time-ordered data.

Training, scoring and metrics are Spark jobs; the driver holds one number per
(setting, fold) and the fitted trees of the chosen forest.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tradewind.forecast import forest
from tradewind.forecast.features import FEATURES
from tradewind.functions import columns as C

# The default search grid, the seed and the smallest |y| in MAPE.
GRID = {
    "n_estimators": [200, 300, 500],
    "max_depth": [6, 8, 10],
    "min_samples_leaf": [2, 3, 5],
}
SEED = 42
MAX_BINS = 64
EPSILON = 2.220446049250313e-16


def settings(grid: dict[str, list]) -> list[dict]:
    """Every combination; names in alphabetical order, the last varies fastest."""
    names = sorted(grid)
    return [dict(zip(names, values))
            for values in itertools.product(*[grid[n] for n in names])]


def assembled(rows: DataFrame) -> DataFrame:
    """Adds the feature vector and the label."""
    numeric = rows.select(
        "series", "order_date", "gmv", F.col("gmv").cast("double").alias("label"),
        *[F.col(f).cast("double").alias(f) for f in FEATURES])
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(numeric).select(
        "series", "order_date", "gmv", "label", "features")


@dataclass
class Forest:
    """Bin edges and trees. A forest of n trees is the first n of any larger one, so one
    gives the predictions for every size in a grid."""

    edges: list[np.ndarray]
    grown: forest.Trees

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with `prediction`, the mean over all trees."""
        return self.by_size(rows, {"prediction": self.trees})

    @property
    def trees(self) -> int:
        return len(self.grown.feature)

    def by_size(self, rows: DataFrame, columns: dict[str, int]) -> DataFrame:
        """`rows` with a prediction column for each number of trees asked for."""
        made = forest.predicted(F.col("features"), self.edges, self.grown, list(columns.values()),
                                rows.sparkSession.sparkContext)
        out = rows.withColumn("_made", made)
        return out.select(*rows.columns, *[F.col("_made")[i].alias(c) for i, c in enumerate(columns)])

    def importances(self) -> list[float]:
        """The share of each feature in the gains of a tree, averaged over the trees."""
        total = np.zeros(len(self.edges))
        for feature, gain in zip(self.grown.feature, self.grown.gain, strict=True):
            own = np.bincount(feature[feature >= 0], gain[feature >= 0], minlength=len(total))
            total += own / own.sum() if own.sum() else 0
        return (total / total.sum()).tolist() if total.sum() else total.tolist()


def fit(train: DataFrame, setting: dict, seed: int = SEED, max_bins: int = MAX_BINS) -> Forest:
    """A forest that considers every feature at every split. `max_bins` bounds the split
    points per feature; a leaf's size counts rows, however often a tree draws them."""
    return Forest(*forest.fit(train, setting["n_estimators"], setting["max_depth"],
                              setting["min_samples_leaf"], seed, max_bins))


# --- splits ------------------------------------------------------------------

def holdout_start(rows: DataFrame, test_months: int) -> DataFrame:
    """One row: the first day of the last `test_months` calendar months."""
    return rows.agg(F.max("order_date").alias("d")).select(
        F.add_months(C.month_start(F.col("d")), 1 - test_months).alias("test_start"))


def train_test_split(rows: DataFrame, test_months: int) -> tuple[DataFrame, DataFrame]:
    marked = rows.withColumn("_start", holdout_start(rows, test_months).scalar())
    before = F.col("order_date") < F.col("_start")
    return marked.filter(before).drop("_start"), marked.filter(~before).drop("_start")


def _extent(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"),
                    F.count(F.lit(1)).alias("rows"))


def split_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    return _extent(train).select(F.lit("train").alias("side"), "*").unionByName(
        _extent(test).select(F.lit("test").alias("side"), "*"))


def checked_extent(rows: DataFrame, side: str) -> Row:
    extent = _extent(rows).first()
    if not extent["rows"]:
        raise ValueError(f"the {side} side of the split is empty")
    return extent


def _day_count(train: DataFrame) -> DataFrame:
    return train.agg(F.min("order_date").alias("first"),
                     (F.datediff(F.max("order_date"), F.min("order_date")) + 1).alias("n"))


def splits_for(n: Column) -> Column:
    """2 to 5 folds, one per 60 training days."""
    return F.least(F.lit(5), F.greatest(F.lit(2), C.int_div(n, F.lit(60)).cast("int")))


def fold_bounds(train: DataFrame, splits: int | None = None) -> DataFrame:
    """Expanding-window folds: `fold`, `test_start` and `test_end` (exclusive).

    Blocks of n div (k + 1) days; each fold trains on all days before its block.
    Days are consecutive, so a fold is a pair of dates.
    """
    k = F.lit(splits) if splits else splits_for(F.col("n"))
    short = F.raise_error(F.concat(
        F.col("n").cast("string"), F.lit(" training days are too few for "),
        F.col("k").cast("string"), F.lit(" folds"))).cast("int")
    sized = _day_count(train).withColumn("k", k).withColumn(
        "size", F.when(F.col("n") > F.col("k"), C.int_div(F.col("n"), F.col("k") + 1).cast("int"))
        .otherwise(short))
    folds = sized.withColumn("fold", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return folds.select(
        "fold", "k",
        F.expr("date_add(first, n - (k - fold) * size)").alias("test_start"),
        F.expr("date_add(first, n - (k - fold) * size + size)").alias("test_end"),
    )


def fold_sizes(train: DataFrame, splits: int | None = None) -> DataFrame:
    """Rows on both sides of every fold."""
    folds = fold_bounds(train, splits).agg(
        F.collect_list(F.struct("fold", "test_start", "test_end")).alias("f"))  # five at most
    days = train.groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    each = days.withColumn("f", folds.scalar()).select("order_date", "n", F.inline("f"))
    earlier = F.col("order_date") < F.col("test_start")
    inside = ~earlier & (F.col("order_date") < F.col("test_end"))
    return each.groupBy("fold", "test_start", "test_end").agg(
        F.sum(F.when(earlier, F.col("n"))).alias("train_rows"),
        F.sum(F.when(inside, F.col("n"))).alias("test_rows"))


# --- metrics -----------------------------------------------------------------

def regression_metrics(predictions: DataFrame, actual: str = "gmv") -> DataFrame:
    """One row with rmse, mae, mape and r2 of `prediction` against `actual`."""
    y, p = F.col(actual).cast("double"), F.col("prediction").cast("double")
    gap = F.abs(y - p)
    residual, spread = F.sum(gap * gap), F.var_pop(y) * F.count(y)
    return predictions.agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(gap).alias("mae"),
        F.avg(gap / F.greatest(F.abs(y), F.lit(EPSILON))).alias("mape"),
        F.when(spread > 0, 1 - residual / spread)
        .when(residual == 0, 1.0).otherwise(0.0).alias("r2"),
    )


def monthly_totals(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("series", C.month_start(F.col("order_date")).alias("month_start")) \
        .agg(F.sum("gmv").alias("gmv"), F.sum("prediction").alias("prediction"))


# --- search ------------------------------------------------------------------

@dataclass
class Search:
    """Outcome of a grid search."""

    scores: list[tuple[dict, int, float]]  # (setting, fold, rmse)
    splits: int
    best: dict
    best_rmse: float
    model: Forest

    def as_rows(self, spark) -> DataFrame:
        """(setting_no, setting, fold, rmse, mean_rmse, is_best)."""
        order = {str(s): i for i, s in enumerate(dict.fromkeys(str(s) for s, _, _ in self.scores))}
        mean = _means(self.scores)
        return spark.createDataFrame(
            [(order[str(s)], str(s), fold, rmse, mean[str(s)], s == self.best)
             for s, fold, rmse in self.scores],
            "setting_no int, setting string, fold int, rmse double, mean_rmse double, "
            "is_best boolean")


def _means(scores) -> dict[str, float]:
    grouped: dict[str, list[float]] = {}
    for setting, _, rmse in scores:
        grouped.setdefault(str(setting), []).append(rmse)
    return {s: sum(v) / len(v) for s, v in grouped.items()}


def grid_search(
    train: DataFrame, grid: dict[str, list] | None = None, splits: int | None = None,
    seed: int = SEED, max_bins: int = MAX_BINS, fitted: Forest | None = None,
) -> Search:
    """Smallest mean RMSE over time-ordered folds; ties go to the first setting.

    `train` is an assembled, settled frame. The forests of all folds and settings are grown
    and scored together; `fitted` is the forest of a grid's only setting, if there is one.
    """
    grid = grid or GRID
    folds = fold_bounds(train, splits).orderBy("fold").collect()  # at most five rows
    found = forest.fold_errors(train, folds, sorted(set(grid["n_estimators"])), sorted(set(grid["max_depth"])),
                               sorted(set(grid["min_samples_leaf"])), seed, max_bins)
    errors = {(r["max_depth"], r["min_samples_leaf"], r["n_estimators"], r["fold"]): r["rmse"]
              for r in found.collect()}  # one row a setting and fold
    ordered = settings(grid)
    scores = [(s, f["fold"], errors[s["max_depth"], s["min_samples_leaf"], s["n_estimators"], f["fold"]])
              for s in ordered for f in folds]
    means = _means(scores)
    best = min(ordered, key=lambda s: means[str(s)])
    model = fitted or fit(train, best, seed, max_bins)
    return Search(scores, len(folds), best, means[str(best)], model)


def importance(model: Forest) -> list[tuple[int, str, float]]:
    """(rank, feature, importance), most important first."""
    pairs = zip(FEATURES, model.importances())
    ordered = sorted(pairs, key=lambda p: -p[1])
    return [(i, name, value) for i, (name, value) in enumerate(ordered, start=1)]
