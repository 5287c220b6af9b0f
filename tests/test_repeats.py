"""Keys seen twice and lookups from the top: exact, and without shuffling what is not needed."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_plans import plan

from tradewind.operators import quality, repeats


def test_gaps_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        for top in (10, 1 << 16, 1 << 40, (1 << 62) - 1):
            at = np.sort(rng.integers(0, top, n).astype(np.uint64))
            assert (repeats.unpacked(repeats.packed(at)) == at).all()
    for at in ([0xFFFE, 2 * 0xFFFE + 1, 3 * 0xFFFE + 2, 1 << 61], [0, 0, 0]):
        assert repeats.unpacked(repeats.packed(np.array(at, np.uint64))).tolist() == at


@pytest.mark.parametrize("kind", ["few", "many", "none", "hot", "empty"])
def test_repeated_equals_plain_grouping(spark, kind, monkeypatch):
    monkeypatch.setattr(repeats, "RANGE_ROWS", 500)
    rng = random.Random(2)
    keys = {"few": range(3000), "many": range(400), "none": None, "hot": range(3000), "empty": []}[kind]
    if kind == "none":
        rows = [(f"k{i}", i) for i in range(3000)]
    else:
        rows = [(f"k{rng.choice(keys)}", rng.randrange(3)) for _ in range(3000 if keys else 0)]
    rows += [("hot", 1)] * (1500 if kind == "hot" else 0) + [(None, 1)] * 5 + [("n", None)] * 5
    df = spark.createDataFrame(rows, "a string, b int").repartition(7)
    for columns in (["a"], ["a", "b"]):
        want = Counter(tuple(r[:len(columns)]) for r in rows if None not in r[:len(columns)])
        want = {k: n for k, n in want.items() if n > 1}
        for most in (repeats.MOST, 0):
            found = repeats.repeated(df, columns, small=0, most=most).collect()
            assert {tuple(r[:-1]): r[-1] for r in found} == want


def test_shared_positions_are_told_apart(spark, monkeypatch):
    """Almost every key meets another one when positions are few."""
    monkeypatch.setattr(repeats, "SPARE", 1)
    df = spark.range(0, 200_000).select(F.col("id").cast("string").alias("a"))
    df = df.union(df.filter("id = 77")) if "id" in df.columns else df.union(df.filter("a = '77'"))
    assert [tuple(r) for r in repeats.repeated(df, ["a"], small=0).collect()] == [("77", 2)]


def written(spark, job):
    """Bytes that the shuffles of a job have written."""
    tracker = spark.sparkContext._jsc.sc().statusStore()
    before = {s.stageId() for s in stages(tracker)}
    job()
    return sum(s.shuffleWriteBytes() for s in stages(tracker) if s.stageId() not in before)


def stages(tracker):
    found = tracker.stageList(None, False, False, spark_doubles(), None)
    return [found.apply(i) for i in range(found.size())]


def spark_doubles():
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    return context._gateway.new_array(context._jvm.double, 0)


def test_unique_keys_are_not_shuffled(spark):
    df = spark.range(0, 400_000, numPartitions=8).select(F.md5(F.col("id").cast("string")).alias("a"))
    plain = written(spark, lambda: df.groupBy("a").count().filter("count > 1").collect())
    own = written(spark, lambda: repeats.repeated(df, ["a"]).collect())
    assert own * 8 < plain


def rows_of(payments, items, n):
    """The join, its order and the cut, as stated."""
    joined = [(p, i) for p in payments for i in items if p[0] == i[0]]
    none = lambda x: (x is None, x)
    joined.sort(key=lambda r: (r[0][4] is None, -(r[0][4] or 0), r[0][0], none(r[1][1]), none(r[0][1])))
    return [(p[0], p[1], p[4], i[1]) for p, i in joined[:n]]


PAYMENT = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value int"
ITEM = "order_id string, order_item_id int, price int, freight_value int"


@pytest.mark.parametrize("sold", ["all", "rare", "late", "none"])
def test_lookup_from_the_top_equals_the_join(spark, sold):
    rng = random.Random(4)
    payments = [(f"o{i:04d}", 1, "card", 1, rng.choice([None, rng.randrange(50)])) for i in range(1200)]
    payments += [(f"o{i:04d}", 2, "card", 1, 7) for i in range(0, 1200, 3)]
    held = {"all": range(1200), "rare": range(0, 1200, 400), "none": [],
            "late": [i for i in range(1200) if payments[i][4] is None]}[sold]
    items = [(f"o{i:04d}", k, 1, 1) for i in held for k in range(1, 1 + i % 3 + 1)]
    p, i = spark.createDataFrame(payments, PAYMENT), spark.createDataFrame(items, ITEM)
    for n in (1, 4, 50):
        got = quality.payment_top_vs_lines(p, i, n).select(
            "order_id", "payment_sequential", "payment_value", "order_item_id").collect()
        assert list(map(tuple, got)) == rows_of(payments, items, n)


def test_lines_are_filtered_and_not_shuffled(spark, monkeypatch):
    plans = []
    keep = quality.settled
    monkeypatch.setattr(quality, "settled", lambda df, name: plans.append((name, plan(df))) or keep(df, name))
    items = spark.range(0, 100_000).selectExpr("cast(id as string) order_id", "1 order_item_id", "1 price", "1 freight_value")
    payments = spark.range(0, 100_000).selectExpr(
        "cast(id as string) order_id", "1 payment_sequential", "'c' payment_type", "1 payment_installments",
        "cast(id as int) payment_value")
    assert quality.payment_top_vs_lines(payments, items, 5).count() == 5
    assert [name for name, _ in plans] == ["largest-payments", "lines"]  # one prefix was enough
    text = plans[1][1]
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") <= 2
    # nothing lies between the lines and the join but their own columns
    assert text.index("BroadcastHashJoin") > text.index("Exchange hashpartitioning")
