"""Vector compression into one small code per part, entries searched in a GNAT.

Components become integers (floor of `SCALE` times the value), vectors are cut into equal
parts, and each part position has a codebook of up to `ENTRIES` integer entries: it starts
as that part of the first vectors and moves to the floored means of its nearest parts in
`ROUNDS` rounds over all vectors. Every part is then coded by its nearest entry.

The nearest entry is found in a geometric near-neighbour access tree: a node has up to
`SPLITS` split points, each other entry belongs to its nearest split point, and the node
keeps the least and greatest distance from every split point to every child's entries. A
query that is d from a split point, with b the best distance so far, drops a child only if
d - b is above that greatest or d + b below that least distance: strictly, and with all
distances rounded away from a drop. So no entry as near as the best is ever dropped, and
integer squared distances, then the lower index, decide ties. A task walks the tree with
all parts of an Arrow batch at once.

Broadcast: the codebooks, `ENTRIES` x dimensions integers. The driver sees one sum per entry
and component. Label sums are joined back on label and salt, so a frequent label is spread.

A vector that is null or holds a null or non-finite component is dropped. One whose length is
not that of the first kept vector (by vec_id, nulls last, then by value), or no positive
multiple of the parts, or that has a component beyond `LARGEST`, cannot be coded: it stays,
with null code and error, and takes no part in the codebooks. Repeated ids and vectors are
rows like others; equal entries go to the lower index. Empty tables give no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import stored

PARTS, ENTRIES, ROUNDS, SCALE, SPLITS, LEAF = 16, 64, 2, 256, 6, 6
LARGEST = 2.0 ** 18  # squared distances of up to 4,096 integers a part then fit 63 bits
SALTS = 16
SLACK = 2.0 ** -50  # relative; above all rounding errors of a square root and one sum


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


class Gnat:
    """Nearest entry of a codebook, ties to the lower index."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        self.entries = entries
        self.splits, self.leaf = splits, leaf
        self.root = self.node(np.arange(len(entries)))
        self.compared = 0  # distances computed, for the tests

    def node(self, held: np.ndarray):
        """(split points, their children, least and greatest distances) or a leaf."""
        if len(held) <= self.leaf:
            return held
        points = self.entries[held]
        chosen, gap = [0], squared(points, points[0])
        while len(chosen) < self.splits and gap.max() > 0:  # each far from those before
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, squared(points, points[chosen[-1]]))
        if len(chosen) == 1:
            return held  # equal entries
        apart = np.array([squared(points, points[c]) for c in chosen])
        nearest = apart.argmin(axis=0)
        nearest[chosen] = np.arange(len(chosen))
        root = np.sqrt(apart.astype(np.float64))
        members = [np.flatnonzero(nearest == j) for j in range(len(chosen))]
        least = np.array([[row[m].min() for m in members] for row in root]) * (1 - SLACK)
        most = np.array([[row[m].max() for m in members] for row in root]) * (1 + SLACK)
        rest = [m[m != c] for m, c in zip(members, chosen, strict=True)]
        children = [self.node(held[m]) if len(m) else None for m in rest]
        return held[chosen], children, least, most

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) for each row."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        self.walk(self.root, queries, np.arange(len(queries)), index, best)
        return index, best

    def meet(self, entry: int, queries: np.ndarray, at: np.ndarray, index: np.ndarray,
             best: np.ndarray) -> np.ndarray:
        """Compare the queries `at` with one entry; their distances as floats."""
        found = squared(queries[at], self.entries[entry])
        self.compared += len(at)
        better = (found < best[at]) | ((found == best[at]) & (entry < index[at]))
        index[at[better]], best[at[better]] = entry, found[better]
        return np.sqrt(found.astype(np.float64))

    def walk(self, node, queries: np.ndarray, at: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        if not isinstance(node, tuple):
            for entry in node.tolist():
                self.meet(entry, queries, at, index, best)
            return
        points, children, least, most = node
        alive = np.ones((len(at), len(points)), bool)
        gone = np.full((len(at), len(points)), np.inf)
        for i, entry in enumerate(points.tolist()):
            asked = np.flatnonzero(alive[:, i])
            if not len(asked):
                continue
            far = self.meet(entry, queries, at[asked], index, best)
            gone[asked, i] = far
            near = np.sqrt(best[at[asked]].astype(np.float64)) * (1 + SLACK)
            drop = (((far * (1 - SLACK) - near) * (1 - SLACK) - near * SLACK)[:, None] > most[i]) | (
                ((far * (1 + SLACK) + near) * (1 + SLACK))[:, None] < least[i])
            alive[asked] &= ~drop
        # The child of the nearest split point first: it lowers the bound of the others.
        order = np.argsort(gone, axis=1, kind="stable")
        for turn in range(len(points)):
            for j, child in enumerate(children):
                if child is None:
                    continue
                mine = np.flatnonzero((order[:, turn] == j) & alive[:, j])
                if turn:  # the bound may have fallen since
                    near = np.sqrt(best[at[mine]].astype(np.float64)) * (1 + SLACK)
                    far = gone[mine, j]
                    seen = np.isfinite(far)
                    far = np.where(seen, far, 0)
                    mine = mine[~seen | ((far * (1 - SLACK) - near) * (1 - SLACK) - near * SLACK <= most[j, j])]
                if len(mine):
                    self.walk(child, queries, at[mine], index, best)


def valid(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
          label_col: str | None = "label") -> DataFrame:
    """(vec_id, label, vector) of the vectors whose components are all finite, as doubles."""
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    cast = F.col(vector_col).cast("array<double>").alias("vector")
    kept = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), cast).filter(
        F.col("vector").isNotNull() & kept)


def whole(rows: DataFrame, dims: int) -> DataFrame:
    """`rows` with the column `whole`: the integers of vectors that can be coded, else null."""
    fits = (F.size("vector") == dims) & F.forall("vector", lambda x: F.abs(x) < LARGEST)
    return rows.select("vec_id", "label", F.when(fits, F.transform(
        "vector", lambda x: F.floor(x * SCALE).cast("long"))).alias("whole"))


class Codebooks:
    """Entries of each part: an integer array [part, entry, component]."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    def trees(self) -> list[Gnat]:
        return [Gnat(part) for part in self.entries]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: list[str]) -> np.ndarray:
        """The entries that the codes name, as vectors of the original scale (bin centres)."""
        parts = len(self.entries)
        at = np.array([[int(c[2 * p:2 * p + 2], 16) for p in range(parts)] for c in codes]).reshape(-1, parts)
        return (self.entries[np.arange(parts), at].reshape(len(at), -1) + 0.5) / SCALE


def matrix(vectors: pd.Series, parts: int) -> np.ndarray:
    """[row, part, component]"""
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), parts, -1)


def searched(vectors: pd.Series, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the parts, nearest entries, squared distances) of one batch."""
    cut = matrix(vectors, len(trees))
    found = [tree.nearest(cut[:, p]) for p, tree in enumerate(trees)]
    return cut, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry to the floored mean of the parts nearest to it."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = shared.value.trees()
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if len(batch):
                cut, at, _ = searched(batch["whole"], trees)
                for p in range(parts):
                    np.add.at(sums[p], at[:, p], cut[:, p])
                    counts[p] += np.bincount(at[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        for i in range(width):
            yield pd.DataFrame({"part": part, "entry": entry, "i": i, "n": counts[part, entry],
                                "s": sums[part, entry, i]})

    found = rows.select("whole").filter("whole is not null").mapInPandas(
        run, "part int, entry int, i int, n long, s long")
    out = books.entries.copy()
    for r in found.groupBy("part", "entry", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        out[r["part"], r["entry"], r["i"]] = r["s"] // r["n"]  # one row an entry and component
    return Codebooks(out)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
        ) -> tuple[DataFrame, Codebooks | None]:
    """(rows with their integers, codebooks) of rows(vec_id, label, vector)."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector")).first()
    dims = first[0] if first else 0
    ready = stored(whole(rows, dims if dims and dims % parts == 0 else -1), "vectors")
    start = ready.filter("whole is not null").orderBy(
        F.col("vec_id").asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    if not start:
        return ready, None
    books = Codebooks(matrix(pd.Series([r[0] for r in start]), parts).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        books = moved(ready, books)
    return ready, books


def coded(rows: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, label, code, error) of rows(vec_id, label, whole)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("code string, error long")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees = shared.value.trees() if shared.value else []
        for batch in batches:
            able = batch.notna().to_numpy()
            out = pd.DataFrame({"code": np.full(len(batch), None, object),
                                "error": pd.array([None] * len(batch), "Int64")})
            if able.any():
                _, at, far = searched(batch[able], trees)
                out.loc[able, "code"] = [row.astype(np.uint8).tobytes().hex() for row in at]
                out.loc[able, "error"] = far.sum(axis=1)
            yield out

    return rows.withColumn("found", code("whole")).select("vec_id", "label", "found.code", "found.error")


def report(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256; two hex digits a part."""
    ready, books = fit(valid(vectors), parts, entries, rounds)
    rows = stored(coded(ready, books), "codes")
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))
    totals = (rows.groupBy("label").agg(F.sum("error").alias("label_error"))
              .select(F.col("label").alias("same"), "label_error",
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")))
    salted = rows.withColumn("salt", salt)
    return salted.join(totals, salted["label"].eqNullSafe(totals["same"]) & (salted["salt"] == totals["s"])
                       ).select("vec_id", "code", "error", "label_error",
                                F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))
