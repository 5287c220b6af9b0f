"""Random forests on binned features, many of them fitted together.

Rows are binned once. All trees then grow level by level from histograms keyed by (tree,
node, feature, bin) of the rows, the drawn weight and the weighted label. Three things keep
a whole grid small:

* a tree of depth d is the top of the deeper one, so only the deepest is grown; each node
  keeps its mean, and a shallower prediction stops earlier;
* a forest of n trees is the first n of any larger one;
* how often a tree draws a row is a Poisson variate from a hash of (tree, row), so folds,
  leaf sizes and partitions agree on it and nothing is resampled.

What remains is one forest per fold and leaf size. Up to `LOCAL_ROWS` rows, blocks of trees
are the unit: the rows of a fold are dealt to each block by one shuffle, and a task grows its
block with numpy, as many trees at a time as `DRAWS` allows. Beyond it rows are the unit: each level is one grouped aggregation
over all trees, and the driver holds the splits found so far (trees times nodes, whatever
the number of rows). Both give the same trees: labels are whole hundredths, so sums are exact
in any order, and ties go to the first feature, then the lowest bin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.session import settled

UNIT = 100.0  # labels are held in hundredths
LOCAL_ROWS = 500_000
TREES_A_TASK = 100
CELLS = 1 << 22  # histogram cells of one pass over the rows
DRAWS = 1 << 20  # (tree, row) pairs that a task holds at a time, or one tree's rows if they are more
MOST_DEPTH = 14
ACCURACY = 20_000
MILLI = 1000.0  # predictions are summed in thousandths of a unit: exact in any order
_POISSON = np.cumsum([np.exp(-1) / float(np.prod(range(1, k + 1))) for k in range(14)])
DRAWN = (np.minimum(_POISSON, 1 - 2.0 ** -53) * 2.0 ** 64).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(rows: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """[tree, row]: how often each tree draws each row key."""
    own = _mix(trees.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    return np.searchsorted(DRAWN, _mix(rows.view(np.uint64)[None] ^ own[:, None]), side="right").astype(np.int64)


# --- bins --------------------------------------------------------------------

def edges_of(rows: DataFrame, max_bins: int) -> list[np.ndarray]:
    """Ascending bin edges of each feature: up to `max_bins` - 1 of its quantiles."""
    width = len(rows.select("features").first()[0])
    probabilities = [i / max_bins for i in range(1, max_bins)]
    parts = rows.select(vector_to_array("features").alias("x"))
    row = parts.agg(*[F.percentile_approx(F.col("x")[i], probabilities, ACCURACY).alias(f"e{i}")
                      for i in range(width)], *[F.max(F.col("x")[i]).alias(f"m{i}") for i in range(width)]).first()
    return [np.array(sorted({e for e in row[f"e{i}"] if e < row[f"m{i}"]})) for i in range(width)]


def bins_of(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """[row, feature]; a value is in bin b if it is above edge b - 1 and at most edge b."""
    return np.stack([np.searchsorted(e, values[:, i]) for i, e in enumerate(edges)], 1).astype(np.uint8)


def binned(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """(key, order_date, y, bins) of assembled rows; y in hundredths."""
    shared = rows.sparkSession.sparkContext.broadcast(edges)

    @F.pandas_udf("binary")
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            values = np.array(part.tolist(), np.float64).reshape(len(part), -1)
            yield pd.Series([b.tobytes() for b in bins_of(values, shared.value)] if len(part) else [], dtype=object)

    return rows.select(F.xxhash64("series", "order_date").alias("key"), "order_date",
                       F.round(F.col("label") * UNIT).cast("long").alias("y"),
                       cut(vector_to_array("features")).alias("bins"))


def matrix(parts: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.uint8).reshape(len(parts), -1)


# --- growing -----------------------------------------------------------------

@dataclass
class Trees:
    """Heap-ordered trees, root at 1: the children of node i are 2 i and 2 i + 1."""

    feature: np.ndarray  # [tree, node], -1 where the node is not split
    split: np.ndarray  # rows with a bin up to it go left
    value: np.ndarray  # mean label, in hundredths
    gain: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Trees:
        if depth > MOST_DEPTH:
            raise ValueError(f"trees are at most {MOST_DEPTH} deep")
        shape = (trees, 2 << depth)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape), np.zeros(shape))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """[tree, row]: the node that each row reaches in at most `depth` steps."""
        at = np.ones((len(self.feature), len(bins)), np.int64)
        tree, row = np.arange(len(at))[:, None], np.arange(len(bins))[None]
        for _ in range(depth):
            f = self.feature[tree, at]
            right = bins[row, np.maximum(f, 0)] > self.split[tree, at]
            at = np.where(f < 0, at, 2 * at + right)
        return at

    def sums(self, bins: np.ndarray, depths: list[int]) -> dict[int, np.ndarray]:
        """Predictions of each row at each depth, added over the trees."""
        a_time = max(1, DRAWS // max(1, len(self.feature)))
        if len(bins) > a_time:
            parts = [self.sums(bins[i:i + a_time], depths) for i in range(0, len(bins), a_time)]
            return {depth: np.concatenate([p[depth] for p in parts]) for depth in depths}
        tree, out, at = np.arange(len(self.feature))[:, None], {}, self.nodes(bins, max(depths))
        for depth in depths:
            up = at.copy()
            while (deep := up >= 2 << depth).any():
                up = np.where(deep, up >> 1, up)
            out[depth] = self.value[tree, up].sum(axis=0)
        return out


def histogram(slot: np.ndarray, bins: np.ndarray, w: np.ndarray, y: np.ndarray, slots: int,
              width: int) -> np.ndarray:
    """[rows, weight, weighted label] x [slot, bin] of one feature."""
    key, size = slot * width + bins, slots * width
    return np.stack([np.bincount(key, minlength=size), np.bincount(key, weights=w, minlength=size),
                     np.bincount(key, weights=w * y, minlength=size)]).reshape(3, slots, width)


class Best:
    """The best split of each slot, fed one feature after the other."""

    def __init__(self, slots: int, leaf: int):
        self.leaf = leaf
        self.score = np.full(slots, -np.inf)
        self.feature = np.full(slots, -1)
        self.split = np.zeros(slots, np.int64)
        self.total = np.zeros((3, slots))

    def add(self, feature: int, cells: np.ndarray) -> None:
        total = cells.sum(axis=2)
        left = np.cumsum(cells, axis=2)[:, :, :-1]
        right = total[:, :, None] - left
        fits = (left[0] >= self.leaf) & (right[0] >= self.leaf)
        score = np.where(fits, left[2] ** 2 / np.maximum(left[1], 1) + right[2] ** 2 / np.maximum(right[1], 1), -np.inf)
        self.total = total
        if not score.shape[1]:
            return
        at = score.argmax(axis=1)
        found = score[np.arange(len(at)), at]
        better = found > self.score
        self.score[better], self.feature[better], self.split[better] = found[better], feature, at[better]

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(feature or -1, split, mean, gain) of each slot."""
        _, w, q = self.total
        whole = q ** 2 / np.maximum(w, 1)
        gain = np.where(np.isfinite(self.score), self.score - whole, 0)
        good = gain > 1e-12 * np.maximum(whole, 1)
        return (np.where(good, self.feature, -1), self.split, q / np.maximum(w, 1), np.where(good, gain, 0))


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, leaf: int, width: int) -> Trees:
    """All trees over the same rows; w is [tree, row]."""
    trees = Trees.empty(len(w), depth)
    tree, row = np.nonzero(w)
    weight = w[tree, row].astype(np.float64)
    label = y[row].astype(np.float64)
    owner, heap = np.arange(len(w)), np.ones(len(w), np.int64)
    slot = tree
    for level in range(depth + 1):
        if not len(slot):
            break
        best = Best(len(owner), leaf)
        if level < depth:
            for f in range(bins.shape[1]):
                best.add(f, histogram(slot, bins[row, f], weight, label, len(owner), width))
        else:
            best.total = histogram(slot, 0 * slot, weight, label, len(owner), 1)[:, :, 0]
        feature, split, value, gain = best.done()
        trees.feature[owner, heap], trees.split[owner, heap] = feature, split
        trees.value[owner, heap], trees.gain[owner, heap] = value, gain
        cut = feature >= 0
        keep = cut[slot]
        slot, row, weight, label = slot[keep], row[keep], weight[keep], label[keep]
        right = bins[row, feature[slot]] > split[slot]
        slot = 2 * (np.cumsum(cut) - 1)[slot] + right
        owner, heap = np.repeat(owner[cut], 2), np.stack([2 * heap[cut], 2 * heap[cut] + 1], 1).ravel()
    return trees


# --- many forests ------------------------------------------------------------

@dataclass(frozen=True)
class Job:
    """A forest's trees `first` to `last` on the rows before `until` (all if None)."""

    number: int
    leaf: int
    first: int
    last: int
    depth: int
    until: object = None
    fold: int = -1
    to: object = None  # rows from `until` on and before it are scored


def _packed(job: Job, trees: Trees) -> tuple:
    return (job.number, trees.feature.tobytes(), trees.split.tobytes(), trees.value.tobytes(), trees.gain.tobytes())


def _unpacked(job: Job, row) -> Trees:
    shape = (job.last - job.first, 2 << job.depth)
    kinds = {"feature": np.int16, "split": np.uint8, "value": np.float64, "gain": np.float64}
    return Trees(**{k: np.frombuffer(row[k], t).reshape(shape) for k, t in kinds.items()})


TREES = "job int, feature binary, split binary, value binary, gain binary"
SCORES = "job int, depth int, key long, y long, s long"


def _dealt(rows: DataFrame, jobs: list[Job]) -> DataFrame:
    """Every row once for each job that trains on it or scores it."""
    listed = rows.sparkSession.createDataFrame(
        [(j.number, j.until, j.to) for j in jobs], "job int, until date, to date")
    at = F.col("order_date")
    return rows.join(F.broadcast(listed), F.col("until").isNull() | (at < F.col("until"))
                     | (at < F.col("to"))).select(
        "job", "key", "y", "bins", (F.col("until").isNull() | (at < F.col("until"))).alias("known"))


def _sums(job: Job, trees: Trees, rows: pd.DataFrame, depths: list[int]) -> pd.DataFrame:
    found = trees.sums(matrix(rows["bins"]), depths)
    return pd.concat([pd.DataFrame({
        "job": job.number, "depth": depth, "key": rows["key"].to_numpy(), "y": rows["y"].to_numpy(),
        "s": np.rint(sums * MILLI).astype(np.int64)}) for depth, sums in found.items()])


def _grown(job: Job, rows: pd.DataFrame, seed: int, width: int) -> Trees:
    """The job's trees over its rows; trees do not depend on each other."""
    key, bins, y = rows["key"].to_numpy(np.int64), matrix(rows["bins"]), rows["y"].to_numpy()
    a_time = max(1, DRAWS // max(1, len(key)))
    parts = [grow(bins, y, drawn(key, np.arange(first, min(first + a_time, job.last)), seed), job.depth, job.leaf, width)
             for first in range(job.first, job.last, a_time)]
    return _joined(parts)


def _joined(parts: list[Trees]) -> Trees:
    return Trees(*[np.concatenate([vars(p)[k] for p in parts]) for k in vars(parts[0])])


def _local(rows: DataFrame, jobs: list[Job], seed: int, width: int, depths: list[int] | None) -> DataFrame:
    """Blocks of trees as tasks: the trees, or the scores of the unseen rows at `depths`."""
    by_number = {j.number: j for j in jobs}

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        job = by_number[key[0]]
        part = part.sort_values("key")  # sums are exact in any order; this keeps memory access alike
        trees = _grown(job, part[part["known"]], seed, width)
        if depths is None:
            return pd.DataFrame([_packed(job, trees)], columns=["job", "feature", "split", "value", "gain"])
        return _sums(job, trees, part[~part["known"]], depths)

    # As many tasks as jobs: one may take seconds, so no two wait for each other.
    return _dealt(rows, jobs).repartition(len(jobs), "job").groupBy("job").applyInPandas(
        run, TREES if depths is None else SCORES)


class _Slots:
    """The nodes of one level that are still to be split, over all jobs."""

    def __init__(self, jobs: list[Job]):
        self.job = np.repeat(np.arange(len(jobs)), [j.last - j.first for j in jobs])
        self.tree = np.concatenate([np.arange(j.last - j.first) for j in jobs])
        self.heap = np.ones(len(self.job), np.int64)

    def kept(self, cut: np.ndarray) -> _Slots:
        out = object.__new__(_Slots)
        out.job, out.tree = np.repeat(self.job[cut], 2), np.repeat(self.tree[cut], 2)
        out.heap = np.stack([2 * self.heap[cut], 2 * self.heap[cut] + 1], 1).ravel()
        return out


def _level(rows: DataFrame, jobs: list[Job], grown: list[Trees], slots: _Slots, level: int, seed: int,
           width: int, features: int) -> tuple[np.ndarray, ...]:
    """(feature, split, mean, gain) of each slot by grouped aggregations over all rows."""
    context = rows.sparkSession.sparkContext
    a_pass = max(1, CELLS // (features * width))
    out = [np.full(len(slots.heap), -1), np.zeros(len(slots.heap), np.int64),
           np.zeros(len(slots.heap)), np.zeros(len(slots.heap))]
    leaves = np.array([j.leaf for j in jobs])
    for start in range(0, len(slots.heap), a_pass):
        at = np.arange(start, min(start + a_pass, len(slots.heap)))
        wanted = {}
        for i in at:
            wanted.setdefault(int(slots.job[i]), []).append(i)
        shared = context.broadcast((grown, wanted, slots.tree, slots.heap))

        def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trees, mine, tree, heap = shared.value
            total = np.zeros((features, 3, len(at), width))
            for batch in batches:
                if not len(batch):
                    continue
                bins, y, key = matrix(batch["bins"]), batch["y"].to_numpy(), batch["key"].to_numpy(np.int64)
                date = batch["order_date"].to_numpy()
                for number, places in mine.items():
                    job = jobs[number]
                    known = slice(None) if job.until is None else date < job.until
                    picked = np.unique(tree[places])
                    own = Trees(*[x[picked] for x in vars(trees[number]).values()])
                    reached = own.nodes(bins[known], level)
                    w = drawn(key[known], job.first + picked, seed)
                    slot = np.full((len(picked), 2 << level), -1)
                    slot[np.searchsorted(picked, tree[places]), heap[places]] = np.array(places) - at[0]
                    found = slot[np.arange(len(picked))[:, None], reached]
                    t, r = np.nonzero((found >= 0) & (w > 0))
                    for f in range(features):
                        total[f] += histogram(found[t, r], bins[known][r, f], w[t, r].astype(np.float64),
                                              y[known][r].astype(np.float64), len(at), width)
            f, s, b = np.nonzero(total[:, 0])
            yield pd.DataFrame({"slot": s, "f": f, "b": b, **{
                name: total[f, i, s, b] for i, name in enumerate(("n", "w", "q"))}})

        def split(_: tuple, part: pd.DataFrame) -> pd.DataFrame:
            numbers, slot = np.unique(part["slot"], return_inverse=True)
            dense = np.zeros((features, 3, len(numbers), width))
            for i, name in enumerate(("n", "w", "q")):
                dense[part["f"], i, slot, part["b"]] = part[name]
            frames = []
            for leaf in np.unique(leaves[slots.job[at[numbers]]]):
                own = leaves[slots.job[at[numbers]]] == leaf
                best = Best(int(own.sum()), int(leaf))
                for f in range(features):
                    best.add(f, dense[f][:, own])
                frames.append(pd.DataFrame(dict(zip(("slot", "feature", "split", "value", "gain"),
                                                    (numbers[own], *best.done()), strict=True))))
            return pd.concat(frames)

        sums = rows.mapInPandas(cells, "slot int, f int, b int, n double, w double, q double").groupBy(
            "slot", "f", "b").agg(*[F.sum(c).alias(c) for c in ("n", "w", "q")])
        found = sums.groupBy((F.col("slot") / 64).cast("int").alias("block")).applyInPandas(
            split, "slot int, feature int, split int, value double, gain double").toPandas()
        where = at[found["slot"].to_numpy(np.int64)]
        for i, name in enumerate(("feature", "split", "value", "gain")):
            out[i][where] = found[name].to_numpy()
    return tuple(out)


def _distributed(rows: DataFrame, jobs: list[Job], seed: int, width: int) -> list[Trees]:
    """Level by level over all rows, for all jobs at once."""
    features = len(rows.select("bins").first()[0])
    grown = [Trees.empty(j.last - j.first, j.depth) for j in jobs]
    slots, level = _Slots(jobs), 0
    while len(slots.heap):
        found = _level(rows, jobs, grown, slots, level, seed, width, features)
        last = np.array([jobs[j].depth for j in slots.job]) <= level
        feature = np.where(last, -1, found[0])
        for number in np.unique(slots.job):
            own = slots.job == number
            where = slots.tree[own], slots.heap[own]
            grown[number].feature[where], grown[number].split[where] = feature[own], found[1][own]
            grown[number].value[where] = found[2][own]
            grown[number].gain[where] = np.where(feature[own] >= 0, found[3][own], 0)
        slots, level = slots.kept(feature >= 0), level + 1
    return grown


def _blocks(sizes: list[int]) -> list[tuple[int, int]]:
    """Trees in blocks that end at every size."""
    ends = sorted({0, *sizes, *range(0, max(sizes), TREES_A_TASK)})
    return list(zip(ends, ends[1:]))


def fit(rows: DataFrame, trees: int, depth: int, leaf: int, seed: int, max_bins: int,
        local_rows: int = LOCAL_ROWS) -> tuple[list[np.ndarray], Trees]:
    """(edges, trees) of one forest over assembled rows."""
    edges = edges_of(rows, max_bins)
    ready = settled(binned(rows, edges), "binned")
    jobs = [Job(i, leaf, a, b, depth) for i, (a, b) in enumerate(_blocks([trees]))]
    if ready.count() <= local_rows:
        found = {r["job"]: r for r in _local(ready, jobs, seed, max_bins, None).collect()}  # trees x nodes
        parts = [_unpacked(j, found[j.number]) for j in jobs]
    else:
        parts = _distributed(ready, jobs, seed, max_bins)
    return edges, _joined(parts)


def fold_errors(rows: DataFrame, folds: list, sizes: list[int], depths: list[int], leaves: list[int],
                seed: int, max_bins: int, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(fold, min_samples_leaf, max_depth, n_estimators, rmse) of a whole grid. `folds` are
    rows (fold, test_start, test_end): a forest sees the days before and is scored inside.
    Bin edges come from all of `rows`, labels do not enter them."""
    spark = rows.sparkSession
    ready = settled(binned(rows, edges_of(rows, max_bins)), "binned")
    blocks = [(f, leaf, a, b) for f in folds for leaf in leaves for a, b in _blocks(sizes)]
    jobs = [Job(i, leaf, a, b, max(depths), f["test_start"], f["fold"], f["test_end"])
            for i, (f, leaf, a, b) in enumerate(blocks)]
    if ready.count() <= local_rows:
        scores = settled(_local(ready, jobs, seed, max_bins, depths), "fold-scores")
    else:
        shared = spark.sparkContext.broadcast(_distributed(ready, jobs, seed, max_bins))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for job in jobs:
                    date = batch["order_date"]
                    own = batch[(date >= job.until) & (date < job.to)]
                    if len(own):
                        yield _sums(job, shared.value[job.number], own, depths)

        scores = settled(ready.mapInPandas(score, SCORES), "fold-scores")
    listed = spark.createDataFrame(
        [(j.number, j.fold, j.leaf, n) for j in jobs for n in sizes if j.last <= n],
        "job int, fold int, min_samples_leaf int, n_estimators int")
    keys = ["fold", "min_samples_leaf", F.col("depth").alias("max_depth"), "n_estimators"]
    each = scores.join(F.broadcast(listed), "job").groupBy(*keys, "key").agg(
        (F.sum("s") / (MILLI * UNIT) / F.col("n_estimators")).alias("p"), (F.first("y") / UNIT).alias("y"))
    gap = F.col("p") - F.col("y")
    return each.groupBy("fold", "min_samples_leaf", "max_depth", "n_estimators").agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"))


def predicted(features: Column, edges: list[np.ndarray], trees: Trees, sizes: list[int], context) -> Column:
    """An array column: the mean of the first n trees for each size."""
    shared = context.broadcast((edges, trees))
    depth = (trees.feature.shape[1] >> 1).bit_length() - 1

    @F.pandas_udf("array<double>")
    def mean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        edges, trees = shared.value
        for part in parts:
            out = []
            for start in range(0, len(part), 1000):
                values = np.array(part.iloc[start:start + 1000].tolist(), np.float64)
                bins = bins_of(values, edges)
                found = trees.value[np.arange(len(trees.value))[:, None], trees.nodes(bins, depth)]
                out += np.stack([found[:n].mean(axis=0) / UNIT for n in sizes], 1).tolist()
            yield pd.Series(out, dtype=object)

    return mean(vector_to_array(features))
