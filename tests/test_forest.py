"""Forests grown together: against plain recursion, alone, and in both ways of working."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tradewind.forecast import forest, model

DAY0 = dt.date(2020, 1, 1)
BINS = 8


def plain_tree(bins, y, w, depth, leaf, node=1, out=None):
    """{node: (feature, split, mean)} by recursion; the first best split wins."""
    out = {} if out is None else out
    keep = [i for i in range(len(y)) if w[i]]
    total, weight = sum(w[i] * y[i] for i in keep), sum(w[i] for i in keep)
    out[node] = (-1, None, total / weight)
    best = (total ** 2 / weight + 1e-12 * max(total ** 2 / weight, 1), None)
    for f in range(len(bins[0])):
        for b in range(BINS - 1):
            left = [i for i in keep if bins[i][f] <= b]
            right = [i for i in keep if bins[i][f] > b]
            if depth and len(left) >= leaf and len(right) >= leaf:
                score = sum(sum(w[i] * y[i] for i in s) ** 2 / sum(w[i] for i in s) for s in (left, right))
                if score > best[0]:
                    best = (score, (f, b, left, right))
    if best[1]:
        f, b, left, right = best[1]
        out[node] = (f, b, total / weight)
        for child, rows in ((2 * node, left), (2 * node + 1, right)):
            plain_tree(bins, y, [w[i] if i in set(rows) else 0 for i in range(len(y))], depth - 1, leaf, child, out)
    return out


def data(seed, n=60, features=3):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, BINS, (n, features)).astype(np.uint8)
    return bins, rng.integers(-500, 5000, n) + 900 * bins[:, 0].astype(int), rng.poisson(1, (4, n))


@pytest.mark.parametrize("seed", range(5))
def test_trees_equal_plain_recursion(seed):
    bins, y, w = data(seed)
    for depth, leaf in ((0, 1), (1, 2), (3, 1), (4, 5)):
        trees = forest.grow(bins, y, w, depth, leaf, BINS)
        for t in range(len(w)):
            want = plain_tree(bins.tolist(), y.tolist(), w[t].tolist(), depth, leaf)
            for node in range(1, 2 << depth):
                assert trees.feature[t, node] == want.get(node, (-1,))[0]
                if node in want:
                    assert trees.value[t, node] == want[node][2]
                    assert want[node][1] is None or trees.split[t, node] == want[node][1]


def test_a_shallow_tree_is_the_top_of_the_deep_one():
    bins, y, w = data(9, 200)
    deep, unseen = forest.grow(bins, y, w, 6, 2, BINS), data(10)[0]
    sums = deep.sums(unseen, [1, 3, 6])
    for depth in (1, 3, 6):
        alone = forest.grow(bins, y, w, depth, 2, BINS).sums(unseen, [depth])
        assert (sums[depth] == alone[depth]).all()


def test_a_row_is_drawn_once_on_average():
    counts = forest.drawn(np.arange(20_000), np.arange(30), 1)
    assert abs(counts.mean() - 1) < 0.01 and abs((counts == 0).mean() - math.exp(-1)) < 0.01
    assert (counts[7:9] == forest.drawn(np.arange(20_000), np.arange(7, 9), 1)).all()


@pytest.fixture(scope="module")
def rows(spark):
    days = spark.range(0, 400, numPartitions=5).select(
        F.lit("s").alias("series"), F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("order_date"),
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 37 % 101).cast("double").alias("b"),
        F.when(F.col("id") % 11 == 0, 0.5).otherwise(F.sin(F.col("id") / 20.0)).alias("c"))
    label = F.round(F.when(F.col("a") > 4, 300).otherwise(100) + F.col("b") + 50 * F.col("c"), 2)
    made = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        days.withColumn("label", label))
    return made.select("series", "order_date", F.col("label").alias("gmv"), "label", "features")


FOLDS = [{"fold": i, "test_start": DAY0 + dt.timedelta(100 * i + 150), "test_end": DAY0 + dt.timedelta(100 * i + 220)}
         for i in range(2)]


def test_both_ways_grow_the_same_trees(rows, monkeypatch):
    monkeypatch.setattr(forest, "CELLS", 3 * 64 * 20)  # several passes a level
    for trees in (1, 7):
        edges, near = forest.fit(rows, trees, 4, 3, 5, 64)
        again, far = forest.fit(rows, trees, 4, 3, 5, 64, local_rows=0)
        assert all((a == b).all() for a, b in zip(edges, again, strict=True))
        for name in ("feature", "value"):
            assert (getattr(near, name) == getattr(far, name)).all()
        split = near.feature >= 0
        assert (near.split[split] == far.split[split]).all()


def test_a_task_holds_few_trees_of_many_rows(monkeypatch):
    rng = np.random.default_rng(3)
    bins, y, _ = data(3, 400)
    part = pd.DataFrame({"key": rng.integers(-2 ** 62, 2 ** 62, 400), "y": y, "bins": [b.tobytes() for b in bins]})
    job, held, plain = forest.Job(0, 2, 5, 25, 3), [], forest.drawn
    whole = forest.grow(bins, y, plain(part["key"].to_numpy(), np.arange(5, 25), 7), 3, 2, BINS)
    scores = whole.sums(bins, [1, 3])

    def watched(rows, trees, seed):
        held.append(len(rows) * len(trees))
        return plain(rows, trees, seed)

    monkeypatch.setattr(forest, "drawn", watched)
    monkeypatch.setattr(forest, "DRAWS", 1500)
    found = forest._grown(job, part, 7, BINS)
    assert max(held) <= 1500 and sum(held) == 20 * 400
    for name, values in vars(whole).items():
        assert (vars(found)[name] == values).all()
    again = found.sums(bins, [1, 3])
    assert all((again[d] == scores[d]).all() for d in scores)


def test_grid_scores_equal_single_forests(rows, monkeypatch):
    monkeypatch.setattr(forest, "TREES_A_TASK", 3)
    sizes, depths, leaves = [2, 5], [2, 4], [1, 6]
    wanted = {}
    edges = forest.edges_of(rows, 32)
    held = forest.binned(rows, edges).toPandas().sort_values("key")
    for fold in FOLDS:
        seen = held[held["order_date"] < fold["test_start"]]
        unseen = held[(held["order_date"] >= fold["test_start"]) & (held["order_date"] < fold["test_end"])]
        for leaf in leaves:
            for depth in depths:
                for n in sizes:
                    w = forest.drawn(seen["key"].to_numpy(), np.arange(n), 3)
                    trees = forest.grow(forest.matrix(seen["bins"]), seen["y"].to_numpy(), w, depth, leaf, 32)
                    made = trees.sums(forest.matrix(unseen["bins"]), [depth])[depth] / n
                    gap = (made - unseen["y"].to_numpy()) / 100
                    wanted[fold["fold"], leaf, depth, n] = math.sqrt((gap * gap).mean())
    for local in (forest.LOCAL_ROWS, 0):
        found = forest.fold_errors(rows, FOLDS, sizes, depths, leaves, 3, 32, local).collect()
        got = {(r["fold"], r["min_samples_leaf"], r["max_depth"], r["n_estimators"]): r["rmse"] for r in found}
        assert got.keys() == wanted.keys()
        assert all(got[k] == pytest.approx(wanted[k], rel=1e-6) for k in wanted)


def test_errors_are_those_of_a_library_forest(rows):
    from pyspark.ml.regression import RandomForestRegressor

    known = rows.filter(F.col("order_date") < FOLDS[1]["test_start"])
    unseen = rows.filter(F.col("order_date") >= FOLDS[1]["test_start"])
    rmse = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))
    own = model.fit(known, {"n_estimators": 40, "max_depth": 6, "min_samples_leaf": 2}).transform(unseen)
    library = RandomForestRegressor(numTrees=40, maxDepth=6, minInstancesPerNode=2, maxBins=64, seed=1,
                                    featureSubsetStrategy="all").fit(known).transform(unseen)
    a, b = own.agg(rmse).first()[0], library.agg(rmse).first()[0]
    assert a < 1.15 * b and a < 30


def test_equal_rows_and_labels(spark, rows):
    flat = rows.withColumn("label", F.lit(5.0))
    assert {r["prediction"] for r in model.fit(flat, {"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 1})
            .transform(rows).select("prediction").collect()} == {5.0}
    one = rows.limit(1)
    made = model.fit(one, {"n_estimators": 50, "max_depth": 2, "min_samples_leaf": 1})
    assert made.transform(rows).select("prediction").first()[0] >= 0
    with pytest.raises(ValueError):
        forest.Trees.empty(1, 20)
