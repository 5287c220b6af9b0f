"""Distributed ranks against plain Python, with ties and a hot value."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import modes, rank


def rows(n, seed=7):
    """Ids with few distinct values; a third of the rows share one of them."""
    rnd = random.Random(seed)
    return [(i, 5 if rnd.random() < 0.34 else rnd.randrange(40)) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, v int")


def ntile(n, k):
    q, r = divmod(n, k)
    return [t + 1 for t in range(k) for _ in range(q + (t < r))]


@pytest.mark.parametrize("n", [1, 3, 7, 23, 1500])
def test_ntile(spark, n):
    data = rows(n)
    got = rank.with_ntile(frame(spark, data), "t", 5, [-F.col("v"), F.col("id")]).collect()
    ordered = sorted(data, key=lambda r: (-r[1], r[0]))
    expected = {r[0]: t for r, t in zip(ordered, ntile(n, 5))}
    assert {r["id"]: r["t"] for r in got} == expected


def test_ntile_of_nothing(spark):
    assert rank.with_ntile(frame(spark, []), "t", 5, [F.col("v"), F.col("id")]).collect() == []


def test_quantiles(spark):
    data = rows(997)
    spots = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q95": 0.95, "q99": 0.99, "q100": 1.0}
    got = rank.quantiles(frame(spark, data), F.col("v"), spots).first()
    values = [v for _, v in data]
    for name, p in spots.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-9)
    one = rank.quantiles(frame(spark, [(1, 4), (2, None)]), F.col("v"), {"q": 0.95}).first()
    assert one["q"] == 4.0
    none = rank.quantiles(frame(spark, [(1, None)]), F.col("v"), {"q": 0.95}).first()
    assert none["q"] is None


def test_approximate_quantiles(spark):
    data = rows(997)
    got = rank.approximate_quantiles(frame(spark, data), F.col("v"), {"q": 0.5}).first()["q"]
    assert abs(got - np.quantile([v for _, v in data], 0.5)) <= 1


def test_running(spark):
    data = rows(800)
    df = frame(spark, data).withColumn("m", F.col("v").cast("decimal(18,2)"))
    got = rank.with_running(df, [-F.col("v"), F.col("id")], F.col("m")).collect()
    total = sum(v for _, v in data)
    running, expected = 0, {}
    for i, (k, v) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), start=1):
        running += v
        expected[k] = (i, Decimal(running), 800, Decimal(total))
    assert {r["id"]: (r["position"], r["running"], r["n"], r["total"]) for r in got} == expected


def test_positions_with_weights(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 6)], "value int, weight long")
    hits = rank.rows_at_ranks(df, [F.col("value")], lambda n: [1, 3, 4, 5, n], F.col("weight"))
    assert [r["value"] for r in hits.orderBy("rank_no").collect()] == [1, 1, 2, 3, 3]


def test_one_value_is_spread_by_its_tie_break(spark):
    df = frame(spark, [(i, 1) for i in range(4000)])
    split = rank.Split(df, [F.col("v"), F.col("id")])
    sizes = [r["count"] for r in split.rows.groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 3


def test_mode(spark):
    data = [(1, "b"), (1, "a"), (1, "b"), (2, "z"), (2, "y"), (3, None)] + [(4, "h")] * 500
    df = spark.createDataFrame(data, "k int, s string")
    rows = modes.grouped_modes(df, ["k"], ["s"]).collect()
    got = {r["k"]: (r["s"], r["s_distinct"]) for r in rows}
    assert got == {1: ("b", 2), 2: ("y", 2), 4: ("h", 1)}


def test_top_share_counts_whole_customers(spark):
    from tradewind.operators import explore
    data = [(i, float(i)) for i in range(1, 12)]  # 11 customers: the first two count
    df = spark.createDataFrame(data, "customer_unique_id long, g double").select(
        "customer_unique_id", F.col("g").cast("decimal(18,2)").alias("order_gmv"),
        F.lit(True).alias("is_delivered"))
    share = explore.top_share(df).first()["top20_gmv_share"]
    assert share == pytest.approx((11 + 10) / 66)
    assert explore.top_share(df.limit(3)).first()["top20_gmv_share"] == 0.0


def test_histogram(spark):
    from tradewind.operators import explore
    rnd = random.Random(3)
    values = [round(rnd.uniform(10, 500), 2) for _ in range(700)] + [250.0] * 300
    df = spark.createDataFrame([(v,) for v in values], "g double").select(
        F.col("g").cast("decimal(18,2)").alias("order_gmv"), F.lit(True).alias("is_delivered"))
    got = explore.gmv_histogram(df).orderBy("bin").collect()
    kept = np.array([v for v in values if v <= np.quantile(values, 0.95)])
    counts, edges = np.histogram(kept, bins=50)
    assert [r["orders"] for r in got] == counts.tolist()
    assert [r["bin_left"] for r in got] == pytest.approx(edges[:-1].tolist())
    flat = explore.gmv_histogram(df.filter("order_gmv = 250")).filter("orders > 0").collect()
    assert [(r["bin"], r["orders"]) for r in flat] == [(25, 300)]
    assert math.isclose(flat[0]["bin_left"], 250.0)


def spread_out(kind, n):
    """Distributions on which bins of equal width put nearly all rows into one."""
    rng = random.Random(7)
    values = {
        "huge": lambda i: 1e300 if i == 5 else rng.random(),
        "infinite": lambda i: [float("inf"), float("-inf"), float("nan")][i % 3] if i < 30 else rng.gauss(0, 1),
        "exponents": lambda i: 10.0 ** rng.uniform(-300, 300) * rng.choice([1, -1]),
        "one value": lambda i: 3.0 if i % 10 else rng.random(),
        "nulls": lambda i: None if i % 2 else rng.choice([1.0, 1e200, 2.0, rng.random()]),
        "steps": lambda i: float(2 ** (i % 50)),
    }[kind]
    return [(values(i), i) for i in range(n)]


@pytest.mark.parametrize("kind", ["huge", "infinite", "exponents", "one value", "nulls", "steps"])
def test_ranks_on_any_distribution(spark, kind, monkeypatch):
    monkeypatch.setattr(rank, "ROWS_A_BIN", 20)
    rows = spread_out(kind, 3000)
    df = spark.createDataFrame(rows, "v double, id int").repartition(6)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] is not None and r[0] != r[0],
                                        0 if r[0] is None or r[0] != r[0] else r[0], r[1]))
    spots = [1, 2, 31, 700, 1500, 1501, 2222, 2990, 3000]
    found = rank.rows_at_ranks(df, [F.col("v"), F.col("id")], lambda n: spots).collect()
    assert {r["position"]: r["id"] for r in found} == {p: order[p - 1][1] for p in spots}
    tiles = {r["id"]: r["t"] for r in rank.with_ntile(df, "t", 5, [F.col("v"), F.col("id")]).collect()}
    assert [tiles[i] for _, i in order] == [1 + k // 600 for k in range(3000)]


def test_bins_that_hold_a_position_are_small(spark):
    """A million doubles, one of them huge and some infinite: no bin of many values is left."""
    x = F.rand(3)
    df = spark.range(0, 1_000_000, numPartitions=8).select(
        F.when(F.col("id") == 7, 1e300).when(F.col("id") % 100_000 == 9, float("inf")).otherwise(x).alias("_k0"),
        F.lit(1).cast("long").alias("_w"))
    keep, rank.ROWS_A_BIN = rank.ROWS_A_BIN, 2000
    try:
        at, bins, inside = rank._narrowed(df, F.col("_k0"), {0: 1, 1: 250_000, 2: 500_000, 3: 999_999})
    finally:
        rank.ROWS_A_BIN = keep
    sizes = dict(bins)
    assert sum(sizes.values()) == 1_000_000
    assert all(sizes[b] <= 2000 for b in inside)
    exact = df.filter(at == next(b for b, p in inside.items() if 1 in p)).agg(F.min("_k0"), F.max("_k0")).first()
    assert exact[0] <= df.agg(F.percentile("_k0", 0.25)).first()[0] * 1.001 and exact[1] < 0.26
