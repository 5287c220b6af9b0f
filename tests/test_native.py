"""The hand-made data set from CSV files through every layer."""

import datetime as dt
from decimal import Decimal as D

import native
import pytest

from tradewind import Warehouse
from tradewind.operators import checks, quality, report
from tradewind.plans import gold
from tradewind.plans.warehouse import TABLES
from tradewind.sources import readers


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    paths = native.write(str(tmp_path_factory.mktemp("raw")))
    return Warehouse.from_csv(spark, paths)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_csv_rules(w):
    reviews = w["raw_order_reviews"].collect()
    assert len(reviews) == 4  # a line break inside quotes does not split a record
    first = next(r for r in reviews if r["review_id"] == "r1" and r["order_id"] == "o1")
    assert first["review_comment_message"] == 'she said "yes"\nand left'
    assert first["review_comment_title"] == "good, really"
    second = next(r for r in reviews if r["review_id"] == "r2")
    assert second["review_comment_title"] == "" and second["review_comment_message"] is None
    assert by(w["raw_customers"], "customer_id")["c1"]["customer_zip_code_prefix"] == "01000"
    assert "brinquedos" in by(w["raw_category_translation"], "product_category_name")


def test_malformed_value_stops_the_load(spark, tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                    "o1,1,boleto,one,5.00\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.raw_csv(spark, "raw_order_payments", str(path)).collect()


def test_silver(w):
    assert w["silver_geolocation"].count() == 4  # repeat and NULL row gone
    products = by(w["silver_products"], "product_id")
    assert products["p2"]["product_category_name_english"] == "Unknown"
    assert products["p3"]["product_category_name_english"] == "Unknown"
    assert products["p3"]["missing_translation_flag"] is True
    assert products["p2"]["missing_translation_flag"] is False
    assert by(w["silver_orders"], "order_id")["o3"]["is_delivery_inconsistency"] is True


def test_dimensions(w):
    customers = by(w["gold_dim_customer"], "customer_id")
    assert customers["c1"]["customer_geo_city"] == "osasco"  # smallest of a tie
    assert customers["c1"]["customer_geo_lat"] == pytest.approx(-23.55)
    assert customers["c5"]["customer_geo_lat"] is None
    people = by(w["gold_dim_unique_customer"], "customer_unique_id")
    assert set(people) == {"ana", "bea", "caio", "dora"}
    ana = people["ana"]
    assert (ana["customer_id_count"], ana["order_count"]) == (3, 3)
    assert ana["customer_city"] == "sao paulo" and ana["has_multiple_locations"] is True
    assert people["dora"]["order_count"] == 0
    assert people["dora"]["first_order_purchase_timestamp"] is None
    products = by(w["gold_dim_product"], "product_id")
    assert products["p2"]["product_volume_cm3"] is None
    assert products["p3"]["product_volume_cm3"] == D("9.000000")
    assert products["p4"]["category_label"] == "Home Comfort 2"
    dates = by(w["gold_dim_date"], "date_day")
    assert len(dates) == 147  # 5 January to 31 May
    assert dates[dt.date(2018, 1, 7)]["day_of_week"] == 7


def test_fact_orders(w):
    orders = by(w["gold_fact_orders"], "order_id")
    assert len(orders) == 7
    o1 = orders["o1"]
    assert (o1["order_item_count"], o1["order_gmv"]) == (2, D("160.00"))
    assert (o1["payment_row_count"], o1["order_payment_total"]) == (3, D("160.00"))
    assert o1["uses_installments"] is True and o1["order_avg_review_score"] == 4.0
    assert o1["is_delayed"] is False and orders["o2"]["is_delayed"] is True
    o3 = orders["o3"]
    assert (o3["order_gmv"], o3["uses_installments"]) == (D("0.00"), False)
    assert o3["is_valid_for_delivery_delay_kpi"] is False and o3["is_delayed"] is False
    o4 = orders["o4"]
    assert (o4["order_item_count"], o4["payment_row_count"], o4["has_review"]) == (0, 0, False)
    assert o4["order_avg_review_score"] is None


def test_fact_items(w):
    items = {(r["order_id"], r["order_item_id"]): r for r in w["gold_fact_order_items"].collect()}
    orphan = items["o-missing", 1]
    assert orphan["has_order"] is False and orphan["is_delivered"] is None
    lost = items["o7", 1]
    assert lost["product_category_name_english"] is None
    assert lost["product_category_label"] == "Unknown"
    assert items["o1", 2]["line_gmv"] == D("50.00") and items["o3", 1]["line_gmv"] is None


def test_reviews_and_people(w):
    assert {(r["review_id"], r["order_id"]) for r in w["gold_fact_order_reviews"].collect()} == {
        ("r1", "o1"), ("r2", "o1"), ("r1", "o2")}
    assert w["gold_customer_delivered_orders"].count() == 6
    assert w["gold_customer_rfm"].count() == 3


def test_marts(w):
    months = by(w["dash_kpi_monthly"], "report_month")
    assert sorted(months) == [dt.date(2018, m, 1) for m in (1, 2, 4, 5)]
    feb = months[dt.date(2018, 2, 1)]
    assert (feb["delivered_orders"], feb["total_orders"], feb["gmv"]) == (2, 1, D("0.00"))
    assert (feb["delivery_delay_denominator"], feb["delivery_delay_rate"]) == (1, 0.0)
    assert feb["avg_review_score"] is None and feb["review_count"] == 0
    jan = months[dt.date(2018, 1, 1)]
    assert (jan["aov"], jan["delivery_delay_rate"], jan["review_count"]) == (160.0, 0.5, 3)
    days = by(w["dash_kpi_daily"], "report_date")
    assert dt.date(2018, 3, 1) not in days and days[dt.date(2018, 2, 28)]["total_orders"] == 1
    categories = [tuple(r) for r in w["dash_category_monthly"].filter(
        "report_month = date'2018-01-01'").orderBy("category_rank").collect()]
    # 'Unknown' (160 + 50) holds NULL and untranslated categories
    assert [(r[1], r[3], r[5]) for r in categories] == [
        ("Unknown", D("210.00"), 1), ("toys", D("110.00"), 2)]
    april = w["dash_category_monthly"].filter("report_month = date'2018-04-01'").collect()
    assert [(r["category"], r["category_label"]) for r in april] == [(None, "Unknown")]


def test_retention_windows(w):
    snapshot = by(w["dash_retention_snapshot"], "metric_code")
    # As of 31 May minus 3 months is 28 February 00:00:00: o3 is before the
    # window, o4 one second later is inside.
    three = snapshot["last_3m_returning_customer"]
    assert (three["total_customers"], three["returning_customers"]) == (3, 2)
    assert snapshot["last_3m_repeat_purchase"]["returning_customers"] == 0
    life = snapshot["lifetime_repeat_purchase"]
    assert (life["total_customers"], life["returning_customers"]) == (3, 2)
    again = checks.retention_metrics(
        w["dash_retention_snapshot"],
        checks.retention_recomputed(w["gold_customer_delivered_orders"], w["gold_dataset_dates"]))
    assert {r["status"] for r in again.collect()} == {"PASS"}
    last = by(w["dash_retention_monthly"].filter("report_month = date'2018-05-01'"),
              "metric_code")
    for code, row in snapshot.items():
        assert row["total_customers"] == last[code]["total_customers"]
        assert row["returning_customers"] == last[code]["returning_customers"]


def test_quality(w):
    domain = by(quality.category_domain(w.raw), "check_name")
    assert domain["raw_order_payments.payment_type"]["invalid_count"] == 1
    rules = by(quality.numeric_rules(w.raw), "check_name")
    assert rules["raw_geolocation.lat/lng out of Brazil range"]["invalid_count"] == 1
    edges = by(quality.referential_integrity(w.raw), "check_name")
    orders = edges["raw_order_items.order_id -> raw_orders.order_id"]
    assert (orders["orphan_count"], orders["child_rows_checked"]) == (1, 7)
    assert edges["raw_products.product_category_name -> "
                 "raw_category_translation.product_category_name"]["orphan_count"] == 1
    probe = quality.review_key_probe(w["raw_order_reviews"]).first()
    assert (probe["distinct_review_id"], probe["distinct_review_order_pairs"]) == (3, 4)
    assert probe["review_order_pair_uniqueness"].startswith("PASS")
    nulls = by(quality.critical_null(w.raw), "check_name")
    assert nulls["raw_customers.customer_unique_id"]["status"] == "FAIL"
    ready = {(r["table_name"], r["feature_name"]): r
             for r in quality.feature_readiness(w.raw).collect()}
    assert len(ready) == 52
    assert ready["raw_order_items", "price"]["null_rate_pct"] == 14.29
    money = quality.payment_reconciliation(
        w["raw_order_payments"], w["raw_order_items"]).first()
    # o3 (no item amount) and o-missing lack a side; only o6 differs by more than 1
    assert (money["missing_side_count"], money["mismatch_count"],
            money["compared_order_count"], money["mismatch_rate_pct"]) == (2, 1, 4, 25.0)
    assert quality.schema_detail(quality.column_profile(w.raw)).count() == 0


def test_empty_tables_are_skipped(w):
    tables = {t: df.limit(0) for t, df in w.raw.items()}
    for check in (quality.critical_null, quality.timestamp_parse, quality.category_domain,
                  quality.numeric_rules, quality.numeric_null_rate):
        assert {r["status"] for r in check(tables).collect()} == {quality.EMPTY}
    assert {r["status"] for r in quality.referential_integrity(tables).collect()} == {
        quality.NO_CHILD}
    assert {r["status"] for r in quality.timestamp_range(tables).collect()} == {quality.ALL_NULL}
    gaps = quality.missing_days_summary(tables["raw_orders"]).first()
    assert (gaps["status"], gaps["expected_days_in_range"]) == (quality.NO_DAY, 0)


def test_missing_table_fails_row_count(w):
    tables = {t: df for t, df in w.raw.items() if t != "raw_sellers"}
    rows = by(quality.row_count(tables), "table_name")
    assert rows["raw_sellers"]["status"] == quality.NO_TABLE


def test_kpi_checks_pass(w):
    assert {r["status"] for r in checks.grain(w).collect()} == {"PASS"}
    logic = by(checks.business_logic(w), "check_name")
    assert {r["status"] for r in logic.values()} == {"PASS"}
    again = checks.monthly_from_facts(
        w["gold_fact_orders"], w["gold_fact_order_items"], w["gold_fact_order_payments"],
        w["gold_fact_order_reviews"])
    assert checks.monthly_metrics(w["dash_kpi_monthly"], again).first()["status"] == "PASS"
    # the NULL category is compared too
    found = checks.category_metrics(
        w["dash_category_monthly"], w["gold_fact_order_items"]).first()
    assert found["category_months_checked"] == w["dash_category_monthly"].count()


def test_stored_warehouse_equals_lazy_one(w, spark, tmp_path):
    stored = Warehouse(spark, lambda t: w[t]).materialise(str(tmp_path))
    for table in TABLES:
        a = sorted(map(str, w[table].collect()))
        b = sorted(map(str, stored[table].collect()))
        assert a == b, table


def test_segments_partition_customers(spark):
    rows = [(r, f, m) for r in range(1, 6) for f in (1, 2, 5) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "r int, f long, m int")
    from pyspark.sql import functions as F
    named = {(x["r"], x["f"], x["m"]): x["s"] for x in df.withColumn(
        "s", gold.segment(F.col("r"), F.col("f"), F.col("m"))).collect()}
    other = {k for k, s in named.items() if s == "Other Customers"}
    assert other == {(3, 1, m) for m in (1, 2, 3)}
    assert {s for (r, _, _), s in named.items() if r <= 2} == {"At Risk", "Hibernating"}
    assert len(set(named.values())) == 7


def test_delay_question(w):
    rows = by(report.delay_vs_repeat(w["gold_fact_orders"]), "first_order_delayed")
    # first orders: ana o1 on time and came back, caio o4 on time; bea's o3 has no date
    assert (rows[False]["customers"], rows[False]["repeat_customers"]) == (2, 1)
    assert True not in rows
