"""Schema checks on a changed extract, and KPI tests on damaged marts."""

import pytest
from pyspark.sql import functions as F

from tradewind import Warehouse, schema
from tradewind.operators import checks, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse.from_testdata(spark, SF)


@pytest.fixture(scope="module")
def catalog(w):
    """Sellers have gained a column, products lost the last one, two item columns changed places."""
    tables = w.raw
    items = tables["raw_order_items"]
    return quality.column_profile({
        **tables,
        "raw_sellers": tables["raw_sellers"].withColumn("seller_note", F.col("seller_city")),
        "raw_products": tables["raw_products"].drop("product_width_cm"),
        "raw_order_items": items.select(*items.columns[:5], "freight_value", "price")})


def test_changed_columns_are_found(catalog):
    counts = {r["table_name"]: r for r in quality.column_count(catalog).collect()}
    assert counts["raw_sellers"]["column_diff"] == 1 and counts["raw_products"]["column_diff"] == -1
    assert {t for t, r in counts.items() if r["status"] != "PASS"} == {"raw_sellers", "raw_products"}
    found = {(r["table_name"], r["expected_column"], r["actual_column"]): r["status"]
             for r in quality.schema_detail(catalog).collect()}
    assert found == {
        ("raw_sellers", None, "seller_note"): quality.SCHEMA_FAULTS["extra"],
        ("raw_products", "product_width_cm", None): quality.SCHEMA_FAULTS["missing"],
        ("raw_order_items", "price", "freight_value"): quality.SCHEMA_FAULTS["other"],
        ("raw_order_items", "freight_value", "price"): quality.SCHEMA_FAULTS["other"]}
    assert quality.schema_summary(catalog).first()["schema_overall_status"] == quality.SCHEMA_BROKEN


def test_a_missing_table_fails(w):
    some = {t: df for t, df in w.raw.items() if t != "raw_sellers"}
    counts = {r["table_name"]: r["status"] for r in quality.column_count(
        quality.column_profile(some)).collect()}
    assert counts["raw_sellers"] == quality.NO_TABLE and len(counts) == len(schema.RAW)


def test_nested_counts_skip_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, None), (None, 3), (None, None)], "a int, b int")
    row = quality._nested_counts(df, {"pairs": ["a", "b"], "ones": ["a"]}).first()
    assert (row["total_rows"], row["pairs"], row["ones"]) == (6, 2, 2)
    none = quality._nested_counts(df.limit(0), {"pairs": ["a", "b"], "ones": ["a"]}).first()
    assert tuple(none) == (0, 0, 0)


def test_damaged_marts_fail(w):
    facts = [w[f"gold_fact_{t}"] for t in ("orders", "order_items", "order_payments", "order_reviews")]
    again, mart = checks.monthly_from_facts(*facts), w["dash_kpi_monthly"]
    first = mart.agg(F.min("report_month")).first()[0]
    here = F.col("report_month") == F.lit(first)
    for column, by in (("gmv", 1), ("total_orders", 1), ("aov", 0.01), ("delivery_delay_rate", 0.01)):
        bad = mart.withColumn(column, F.when(here, F.col(column) + by).otherwise(F.col(column)))
        assert checks.monthly_metrics(bad, again).first()["status"] == "FAIL", column
    assert checks.monthly_metrics(mart, again).first()["status"] == "PASS"
    categories = w["dash_category_monthly"]
    bad = categories.withColumn("category_order_count", F.col("category_order_count") + here.cast("int"))
    assert checks.category_metrics(bad, facts[1]).first()["status"] == "FAIL"
    snapshot = w["dash_retention_snapshot"]
    sets = checks.retention_recomputed(w["gold_customer_delivered_orders"], w["gold_dataset_dates"])
    bad = snapshot.withColumn("returning_customers", F.col("returning_customers") + 1)
    assert {r["status"] for r in checks.retention_metrics(bad, sets).collect()} == {"FAIL"}
    assert {r["status"] for r in checks.retention_metrics(snapshot, sets).collect()} == {"PASS"}
