"""Plan guards: pushdown, no single-task windows over rows, no range joins."""

import pytest

from tradewind import Warehouse
from tradewind.operators import intervals, quality
from tradewind.plans import gold

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse.from_testdata(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_files(spark):
    from tradewind.sources.readers import table_scan
    text = plan(table_scan(spark, f"{SF}/orders.parquet", "o_orderkey", "o_orderstatus").filter(
        "o_orderstatus = 'F'").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_partition_filter_prunes_months(w, tmp_path):
    stored = w.materialise(str(tmp_path), "gold_fact_order_payments")["gold_fact_order_payments"]
    text = plan(stored.filter("order_purchase_month = date'1996-01-01'"))
    assert "PartitionFilters: [isnotnull(order_purchase_month" in text


def test_rfm_has_no_single_partition_exchange(w):
    metrics = gold.customer_metrics(w["gold_fact_orders"], w["gold_dataset_dates"])
    text = plan(gold.customer_rfm(metrics))
    assert "Window" not in text and "SinglePartition" not in text


@pytest.mark.parametrize("table", ["dash_retention_monthly", "dash_retention_snapshot"])
def test_retention_has_no_nested_loop(w, table):
    text = plan(w[table])
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_interval_operators_have_no_nested_loop(w):
    df, ts = w["gold_customer_delivered_orders"], "order_purchase_timestamp"
    for made in (intervals.up_to_month_end(df, ts),
                 intervals.in_window(df, ts, "customer_unique_id", 3),
                 intervals.before_window(df, ts, "customer_unique_id", 6)):
        assert "NestedLoop" not in plan(made)


def test_monthly_mart_shuffles_each_input_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = Warehouse.from_testdata(spark, SF)["dash_kpi_daily"]
        # orders, items and payments by order_id, then the days
        assert plan(mart).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unused_child_totals_are_not_computed(w):
    text = plan(w["gold_fact_orders"].select("order_id", "order_gmv"))
    assert "events.parquet" not in text  # reviews
    assert text.count("lineitem.parquet") == 1  # items, not payments


def test_top_k_is_not_a_full_sort(w):
    assert "TakeOrderedAndProject" in plan(quality.payment_top(w["raw_order_payments"]))
    lines = plan(quality.payment_top_vs_lines(w["raw_order_payments"], w["raw_order_items"]))
    assert "WindowGroupLimit" in lines and "TakeOrderedAndProject" in lines


def test_readiness_scans_each_table_once(w):
    text = plan(quality.feature_readiness(w.raw))
    assert text.count("lineitem.parquet") == 2  # items and payments
    assert text.count("events.parquet") == 1


def test_heavy_partition_is_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from tradewind.sources import sinks

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "100KB")
    try:
        heavy = F.when(F.col("id") % 3 == 0, "2018-01").otherwise(
            F.concat(F.lit("2017-"), (F.col("id") % 12).cast("string")))
        df = spark.range(0, 300_000, numPartitions=8).select(
            "id", F.xxhash64("id").alias("x"), heavy.alias("m"))
        stored = sinks.overwrite(df, str(tmp_path / "t"), "m")
        assert stored.count() == 300_000
        assert len(list((tmp_path / "t").glob("v-*/table/m=2018-01/*.parquet"))) > 2
    finally:
        spark.conf.unset(key)


def test_customer_dimension_reads_orders_and_customers_once(spark, monkeypatch):
    plans = []
    keep = gold.settled
    monkeypatch.setattr(gold, "settled", lambda df, name: plans.append(plan(df)) or keep(df, name))
    made = Warehouse.from_testdata(spark, SF)["gold_dim_unique_customer"]
    assert len(plans) == 1 and "Expand" not in plans[0] + plan(made)
    assert plans[0].count("customer.parquet") == 2  # persons, and the places of zip prefixes
    assert "orders.parquet" not in plan(made)


def test_ranks_store_no_copy_of_the_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tradewind.operators import rank
    sizes = []
    keep = rank.settled
    monkeypatch.setattr(rank, "settled", lambda df, name: sizes.append(keep(df, name)) or sizes[-1])
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 997).alias("v"))
    assert rank.with_ntile(df, "t", 5, [F.col("v"), F.col("id")]).groupBy("t").count().count() == 5
    assert rank.quantiles(df, F.col("v"), {"q": 0.5}).first()["q"] == 498
    assert all(s.count() < 200 for s in sizes)
