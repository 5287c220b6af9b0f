"""Global ranks, quantiles and running totals without a single-task window.

Rows at a few positions are found by counting: rows between pivots of the leading key, then,
in rounds, between finer pivots inside the bins that hold a position, until such a bin is
small or a single value, then the counts of the values left there. Only
rows that tie on such a value are ordered by the other keys.

Totals over a whole order need every row: rows are range partitioned by the whole sort
tuple (key, tie-break), so even one dominant key value is spread by its tie-break, into
buckets of about `ROWS_A_BUCKET` rows. The split is stored with its bucket number: a lost
task cannot change it, and later passes read it back. The driver holds one total per
bucket or bin; rows stay in Spark.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import settled


ROWS_A_BUCKET = ROWS_A_BIN = 1_000_000
PIVOTS, ACCURACY = 64, 2000


class Split:
    """`df` stored in ascending buckets of the tuple `order`.

    `rows` is its known size. There are at least as many buckets as shuffle partitions.
    """

    def __init__(self, df: DataFrame, order: list[Column], rows: int = 0):
        width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                    -(-rows // ROWS_A_BUCKET))
        self.keys = [f"_s{i}" for i in range(len(order))]
        keyed = df.select("*", *[c.alias(k) for c, k in zip(order, self.keys)])
        ranged = keyed.repartitionByRange(width, *self.keys)
        self.rows = settled(ranged.withColumn("_bucket", F.spark_partition_id()), "split")

    def upto(self) -> Window:
        """All rows of a bucket up to the current one."""
        return Window.partitionBy("_bucket").orderBy(*self.keys).rowsBetween(
            Window.unboundedPreceding, 0)

    def totals(self, **measures: Column) -> list[tuple]:
        """Ascending (bucket, totals before it..., totals in it...)."""
        sums = self.rows.groupBy("_bucket").agg(*[F.sum(c).alias(n) for n, c in measures.items()])
        before, out = [0] * len(measures), []
        for row in sorted(sums.collect(), key=lambda r: r["_bucket"]):  # one row per bucket
            here = [row[n] if row[n] is not None else 0 for n in measures]
            out.append((row["_bucket"], tuple(before), tuple(here)))
            before = [b + h for b, h in zip(before, here)]
        return out


def _ordered_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _number(key: str, kind: T.DataType) -> Column:
    """The key as a double that never falls where the key rises; NULL is the lowest."""
    c = F.col(key)
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    return c.cast("double")


def _held(sums: list[tuple], wanted: dict[int, int]) -> dict:
    """Which bin holds each position: {bin: ({index: position within the bin})}."""
    out, before = {}, 0
    for key, weight in sums:
        inside = {i: p - before for i, p in wanted.items() if before < p <= before + weight}
        if inside:
            out[key] = inside
        before += weight
    return out


def _pivots(number: Column, held: list) -> Column:
    """The bin of a number between ascending pivots: 2 i + 1 at the i-th, 2 i below it and above the
    one before. A balanced tree of comparisons, NaN above all numbers."""
    def node(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(2 * lo)
        mid = (lo + hi) // 2
        at = F.lit(held[mid])
        return F.when(number < at, node(lo, mid)).when(number <= at, F.lit(2 * mid + 1)).otherwise(
            node(mid + 1, hi))

    return F.when(number.isNull(), F.lit(-1)).otherwise(node(0, len(held)))


def _narrowed(rows: DataFrame, number: Column, wanted: dict[int, int]) -> tuple[Column, list, dict]:
    """(bin of a row, (bin, weight) ascending, {bin: positions inside}): bins so narrow that one with a
    position has at most `ROWS_A_BIN` rows or a single value, on any distribution.

    Pivots are approximate quantiles of the rows in work, so they follow the values wherever
    these lie. Each round counts exactly between them and goes on inside the bins that hold a
    position and are still too large. A pivot is a bin of its own: a frequent value is
    set apart, and what is left between two pivots has fewer values than before.
    """
    shares = [i / PIVOTS for i in range(PIVOTS + 1)]
    found = rows.agg(F.percentile_approx(number, shares, ACCURACY)).first()[0] or []
    while True:
        held = sorted(set(found), key=lambda v: (v != v, v))
        at = _pivots(number, held)
        bins = rows.groupBy(at.alias("bin")).agg(
            F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n"), (F.min(number) < F.max(number)).alias("wide")
        ).orderBy("bin").collect()  # two a pivot
        inside = _held([(r["bin"], r["w"]) for r in bins], wanted)
        large = [r["bin"] for r in bins if r["bin"] in inside and r["wide"] and r["n"] > ROWS_A_BIN]
        if not large:
            return at, [(r["bin"], r["w"]) for r in bins], inside
        finer = rows.filter(at.isin(large)).groupBy(at.alias("bin")).agg(
            F.percentile_approx(number, shares, ACCURACY).alias("p")).collect()
        # Only pivots beside a bin with a position are of further use.
        found = [held[i] for i in sorted({j for b in inside for j in (b // 2 - 1, b // 2) if 0 <= j < len(held)})]
        found += [v for r in finer for v in r["p"]]


def _positions_of_values(rows: DataFrame, kind: T.DataType, wanted: dict[int, int]) -> DataFrame:
    """(rank_no, value, at): the leading key `_k0` at each position of rows(_k0, _w), and the
    position among the rows with that value."""
    spark, number = rows.sparkSession, _number("_k0", kind)
    at, _, inside = _narrowed(rows, number, wanted)
    spots = [(b, i, p) for b, places in inside.items() for i, p in places.items()]
    asked = spark.createDataFrame(spots, "_bin int, rank_no int, _p long")
    counts = rows.withColumn("_bin", at).filter(F.col("_bin").isin(list(inside))).groupBy(
        "_bin", "_k0").agg(F.sum("_w").alias("_w"))
    upto = Window.partitionBy("_bin").orderBy("_k0").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_to", F.sum("_w").over(upto))
    return placed.join(F.broadcast(asked), "_bin").filter(
        (F.col("_p") <= F.col("_to")) & (F.col("_p") > F.col("_to") - F.col("_w"))).select(
        "rank_no", F.col("_k0").alias("value"), (F.col("_p") - F.col("_to") + F.col("_w")).alias("at"),
        F.col("_w").alias("ties"))


def rows_at_ranks(
    df: DataFrame, order: list[Column], ranks: Callable[[int], list[int]],
    weight: Column | None = None,
) -> DataFrame:
    """Rows that cover given 1-based positions of a total order.

    `ranks(n)` lists positions for a frame of n. `weight` (default 1) is the
    number of positions a row covers. Returns one row per listed position:
    `rank_no` (index in the list), `position`, `n` and the columns of `df`. NULL keys
    come first.
    """
    columns = df.columns
    rows = df.select("*", *[c.alias(f"_k{i}") for i, c in enumerate(order)],
                     (weight if weight is not None else F.lit(1)).cast("long").alias("_w"))
    n = rows.agg(F.sum("_w")).first()[0] or 0
    wanted = {i: p for i, p in enumerate(ranks(n)) if 1 <= p <= n}
    listed = df.sparkSession.createDataFrame(list(wanted.items()), "rank_no int, position long")
    kind = rows.schema["_k0"].dataType
    if not wanted or not _ordered_number(kind):
        return _sorted_at(rows, len(order), wanted, n, columns)
    found = settled(_positions_of_values(rows.select("_k0", "_w"), kind, wanted), "ranks")
    most = found.agg(F.max("ties")).first()[0]
    hit = rows.join(F.broadcast(found.select(F.col("value").alias("_v")).distinct()),
                    F.col("_k0").eqNullSafe(F.col("_v"))).drop("_v")
    if len(order) == 1 or most == 1:  # any row with the value is the one
        one = hit.groupBy("_k0").agg(F.first(F.struct(*columns)).alias("_row"))
        out = found.join(one, found["value"].eqNullSafe(one["_k0"])).select("rank_no", "_row.*")
        return out.join(F.broadcast(listed), "rank_no").select(
            "rank_no", "position", F.lit(n).cast("long").alias("n"), *columns)
    # Positions inside the tied rows alone, value after value.
    spots, before = {}, 0
    per_value: dict = {}
    for row in found.orderBy("value").collect():  # one per position
        per_value.setdefault(row["value"], (row["ties"], []))[1].append((row["rank_no"], row["at"]))
    for ties, places in per_value.values():
        spots.update({i: before + at for i, at in places})
        before += ties
    out = _sorted_at(hit, len(order), spots, before, columns).drop("position", "n")
    return out.join(F.broadcast(listed), "rank_no").select(
        "rank_no", "position", F.lit(n).cast("long").alias("n"), *columns)


def _sorted_at(rows: DataFrame, width: int, wanted: dict[int, int], n: int,
               columns: list[str]) -> DataFrame:
    """Rows at positions of the order `_k0`, `_k1`, …; only buckets that hold one are sorted."""
    keys = [f"_k{i}" for i in range(width)]
    split = Split(rows, [F.col(k) for k in keys], n)
    totals = split.totals(w=F.col("_w"))
    entries = [
        (bucket, before, [(i, p) for i, p in wanted.items() if before < p <= before + here])
        for bucket, (before,), (here,) in totals
    ]
    entries = [entry for entry in entries if entry[2]]
    listed = rows.sparkSession.createDataFrame(
        entries, "_bucket int, _before long, _wanted array<struct<rank_no:int,position:long>>")
    hit = (
        split.rows.filter(F.col("_bucket").isin([bucket for bucket, _, _ in entries]))
        .join(F.broadcast(listed), "_bucket")  # at most one row per position
        .withColumn("_to", F.col("_before") + F.sum("_w").over(split.upto()))
        .withColumn("_wanted", F.filter("_wanted", lambda r: (
            (r["position"] <= F.col("_to")) & (r["position"] > F.col("_to") - F.col("_w")))))
        .filter(F.size("_wanted") > 0)
    )
    return hit.select(F.inline("_wanted"), F.lit(n).cast("long").alias("n"), *columns)


def tuples_at_ranks(
    df: DataFrame, order: list[Column], ranks: Callable[[int], list[int]]
) -> list[Column]:
    """The sort tuples at a few positions, as constants to compare with."""
    keys = df.select(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    names = [F.col(c) for c in keys.columns]
    hits = rows_at_ranks(keys, names, ranks).orderBy("rank_no").collect()  # one per position
    return [
        F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in keys.schema.fields])
        for row in hits
    ]


def with_ntile(df: DataFrame, name: str, tiles: int, order: list[Column]) -> DataFrame:
    """`ntile(tiles)` over the whole frame; `order` must be unique.

    Finds the last row of each tile but the final one, then compares every row
    with those few tuples. The frame itself is not shuffled or sorted.
    """
    def ends(n: int) -> list[int]:
        q, r = divmod(n, tiles)
        return [q * i + min(i, r) for i in range(1, tiles)]

    cuts = tuples_at_ranks(df, order, ends)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    passed = [(key > cut).cast("int") for cut in cuts]
    return df.withColumn(name, sum(passed, F.lit(1)))


def with_running(df: DataFrame, order: list[Column], measure: Column) -> DataFrame:
    """Adds `position`, `n`, `running` and `total` of `measure` in a global order."""
    split = Split(df.withColumn("_m", measure), order, df.count())
    totals = split.totals(w=F.lit(1).cast("long"), m=F.col("_m"))
    n = sum(w for _, _, (w, _) in totals)
    total = sum(m for _, _, (_, m) in totals)
    exact = split.rows.select(F.sum("_m").alias("m")).schema["m"].dataType
    offsets = df.sparkSession.createDataFrame(
        [(bucket, w, str(m)) for bucket, (w, m), _ in totals],
        "_bucket int, _w_before long, _m_before string",
    ).withColumn("_m_before", F.col("_m_before").cast(exact))
    upto = split.upto()
    return (
        split.rows.join(F.broadcast(offsets), "_bucket")  # one row per bucket
        .withColumn("position", F.col("_w_before") + F.count(F.lit(1)).over(upto))
        .withColumn("running", F.col("_m_before") + F.coalesce(F.sum("_m").over(upto), F.lit(0)))
        .withColumn("n", F.lit(n).cast("long"))
        .withColumn("total", F.lit(str(total)).cast(exact))
        .drop(*split.keys, "_m", "_bucket", "_w_before", "_m_before")
    )


def value_counts(df: DataFrame, column: Column) -> DataFrame:
    """(value, weight) of the non-NULL values: repeated values collapse map-side."""
    return df.select(column.alias("value")).filter("value IS NOT NULL").groupBy("value").agg(
        F.count(F.lit(1)).alias("weight"))


def quantiles(df: DataFrame, column: Column, probabilities: dict[str, float]) -> DataFrame:
    """One row of exact, linearly interpolated quantiles as double.

    Same definition as `percentile`, but no task holds all values: the two rows
    around each position are located by rank.
    """
    return _quantiles(df.select(column.alias("value")).filter("value IS NOT NULL"), None,
                      probabilities)


def quantiles_of_counts(counts: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    """Quantiles of a (value, weight) frame."""
    return _quantiles(counts, F.col("weight"), probabilities)


def _quantiles(rows: DataFrame, weight: Column | None, probabilities: dict[str, float]) -> DataFrame:
    probs = list(probabilities.items())

    def around(n: int) -> list[int]:
        spots = [(n - 1) * p for _, p in probs]
        return [side(at) + 1 for at in spots for side in (math.floor, math.ceil)]

    hits = rows_at_ranks(rows, [F.col("value")], around, weight)

    def pick(i: int) -> Column:
        return F.max(F.when(F.col("rank_no") == i, F.col("value").cast("double")))

    out = []
    for i, (name, p) in enumerate(probs):
        at = (F.max("n") - 1) * F.lit(p)
        low, high = pick(2 * i), pick(2 * i + 1)
        out.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return hits.agg(*out)


def approximate_quantiles(
    df: DataFrame, column: Column, probabilities: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """One-pass variant; the rank error is at most n / accuracy."""
    arr = df.agg(F.percentile_approx(column, list(probabilities.values()), accuracy).alias("q"))
    return arr.select(*[
        F.get("q", F.lit(i)).cast("double").alias(n) for i, n in enumerate(probabilities)
    ])
