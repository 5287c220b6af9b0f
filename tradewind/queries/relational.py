"""Projection, filter, join, aggregate, window, sort, set and scalar operators,
each alone over the warehouse tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.functions import columns as C
from tradewind.operators import explore, intervals, modes, quality, rank
from tradewind.operators.quality import union
from tradewind.queries import query
from tradewind.queries.views import label
from tradewind.schema import RETENTION_CODES

col, lit = F.col, F.lit

# --- projections -------------------------------------------------------------


@query("proj_select_alias", """
    SELECT customer_id AS id, customer_state AS state, customer_city AS city
    FROM raw_customers""")
def _(w):
    return w["raw_customers"].select(
        col("customer_id").alias("id"), col("customer_state").alias("state"),
        col("customer_city").alias("city"))


@query("proj_arith", """
    SELECT order_id, order_item_id, product_id, price + coalesce(freight_value, 0) AS line_gmv,
        price::DOUBLE / 1000 AS price_thousands,
        (0.5 * order_item_id + 0.5 * 3)::DOUBLE AS weighted
    FROM raw_order_items""", "line_gmv")
def _(w):
    return w["raw_order_items"].select(
        "order_id", "order_item_id", "product_id", C.line_gmv().alias("line_gmv"),
        (col("price").cast("double") / 1000).alias("price_thousands"),
        (col("order_item_id") * 0.5 + lit(0.5) * 3).alias("weighted"))


@query("proj_case", """
    SELECT product_id, CASE WHEN product_weight_g >= 4000 THEN 'heavy'
        WHEN product_weight_g >= 2000 THEN 'medium' ELSE 'light' END AS weight_class,
        CASE WHEN product_photos_qty > 2 THEN 'many' END AS photos
    FROM raw_products""")
def _(w):
    grams = col("product_weight_g")
    return w["raw_products"].select(
        "product_id",
        F.when(grams >= 4000, "heavy").when(grams >= 2000, "medium").otherwise("light")
        .alias("weight_class"),
        F.when(col("product_photos_qty") > 2, "many").alias("photos"))


@query("proj_bool_flag", """
    SELECT order_id, payment_sequential, payment_installments > 1 AS split,
        payment_type = 'credit_card' AND payment_value > 50000 AS large_card
    FROM raw_order_payments""")
def _(w):
    return w["raw_order_payments"].select(
        "order_id", "payment_sequential", (col("payment_installments") > 1).alias("split"),
        ((col("payment_type") == "credit_card") & (col("payment_value") > 50000))
        .alias("large_card"))


@query("proj_coalesce_nullif", """
    SELECT order_id, coalesce(freight_value, 0) AS freight, nullif(order_item_id, 1) AS later_item
    FROM raw_order_items""", "freight")
def _(w):
    return w["raw_order_items"].select(
        "order_id", F.coalesce("freight_value", lit(0)).alias("freight"),
        F.nullif("order_item_id", lit(1)).alias("later_item"))


@query("proj_cast", """
    SELECT order_id::VARCHAR AS order_text, order_purchase_timestamp::DATE AS day,
        strftime(order_purchase_timestamp, '%Y%m%d')::INT AS day_key FROM raw_orders""")
def _(w):
    return w["raw_orders"].select(
        col("order_id").cast("string").alias("order_text"), C.purchase_day().alias("day"),
        F.date_format("order_purchase_timestamp", "yyyyMMdd").cast("int").alias("day_key"))


@query("proj_literal_tag", """
    SELECT 'orders' AS metric_code, order_status, count(*) AS value
    FROM raw_orders GROUP BY order_status""")
def _(w):
    return w["raw_orders"].groupBy("order_status").agg(F.count(lit(1)).alias("value")).select(
        lit("orders").alias("metric_code"), "order_status", "value")


# --- filters -----------------------------------------------------------------


@query("flt_eq_status", "SELECT order_id FROM raw_orders WHERE order_status = 'delivered'")
def _(w):
    return w["raw_orders"].filter(col("order_status") == "delivered").select("order_id")


@query("flt_not_null", """
    SELECT order_id, order_approved_at FROM raw_orders
    WHERE order_approved_at IS NOT NULL AND order_delivered_customer_date IS NULL""")
def _(w):
    return w["raw_orders"].filter(
        col("order_approved_at").isNotNull() & col("order_delivered_customer_date").isNull()
    ).select("order_id", "order_approved_at")


@query("flt_in_list", """
    SELECT product_id, product_category_name FROM raw_products
    WHERE product_category_name IS NOT NULL
        AND product_category_name NOT IN ('standard', 'small')""")
def _(w):
    name = col("product_category_name")
    return w["raw_products"].filter(name.isNotNull() & ~name.isin("standard", "small")).select(
        "product_id", "product_category_name")


@query("flt_range", """
    SELECT order_id FROM raw_orders WHERE order_purchase_timestamp > TIMESTAMP '1996-03-31'
        AND order_purchase_timestamp <= TIMESTAMP '1996-06-30'""")
def _(w):
    ts = col("order_purchase_timestamp")
    lo, hi = (lit(t).cast("timestamp_ntz") for t in ("1996-03-31", "1996-06-30"))
    return w["raw_orders"].filter((ts > lo) & (ts <= hi)).select("order_id")


@query("flt_like_escape", r"""
    SELECT product_id, product_category_name_english FROM silver_products
    WHERE product_category_name_english LIKE 'small\_%' ESCAPE '\'""")
def _(w):
    name = col("product_category_name_english")
    return w["silver_products"].filter(name.like("small\\_%")).select(
        "product_id", "product_category_name_english")


@query("flt_diff_tolerance", """
    SELECT order_id, abs(gmv - paid) AS gap FROM item_totals JOIN payment_totals USING (order_id)
    WHERE abs(gmv - paid) > 100""", "gap")
def _(w):
    return w.order_facts().filter(
        (col("order_item_count") > 0) & (col("payment_row_count") > 0)).select(
        "order_id", F.abs(col("order_gmv") - col("order_payment_total")).alias("gap")
    ).filter("gap > 100")


@query("flt_anomaly_any", """
    SELECT order_id, order_item_id, product_id FROM raw_order_items
    WHERE freight_value IS NULL OR price < 1000 OR order_item_id > 6""")
def _(w):
    bad = col("freight_value").isNull() | (col("price") < 1000) | (col("order_item_id") > 6)
    return w["raw_order_items"].filter(bad).select("order_id", "order_item_id", "product_id")


# --- joins -------------------------------------------------------------------


@query("join_left_equi", """
    SELECT p.product_id, t.product_category_name_english FROM raw_products p
    LEFT JOIN raw_category_translation t ON p.product_category_name = t.product_category_name""")
def _(w):
    return w["raw_products"].join(
        w["raw_category_translation"], "product_category_name", "left").select(
        "product_id", "product_category_name_english")


@query("join_inner_equi", """
    SELECT r.review_id, o.order_status FROM raw_order_reviews r
    JOIN raw_orders o ON r.order_id = o.order_id""")
def _(w):
    return w["raw_order_reviews"].join(w["raw_orders"], "order_id").select(
        "review_id", "order_status")


@query("join_left_composite", """
    SELECT p.order_id, p.payment_sequential, p.n, i.lines FROM
        (SELECT order_id, payment_sequential, payment_type, count(*) AS n FROM raw_order_payments
         GROUP BY ALL) p
    LEFT JOIN (SELECT order_id, order_item_id, 'boleto' AS payment_type, count(*) AS lines
               FROM raw_order_items GROUP BY ALL) i
        ON p.order_id = i.order_id AND p.payment_sequential = i.order_item_id
        AND p.payment_type = i.payment_type""")
def _(w):
    keys = ["order_id", "payment_sequential", "payment_type"]
    payments = w["raw_order_payments"].groupBy(*keys).agg(F.count(lit(1)).alias("n"))
    lines = w["raw_order_items"].groupBy(
        "order_id", col("order_item_id").alias("payment_sequential")
    ).agg(F.count(lit(1)).alias("lines")).withColumn("payment_type", lit("boleto"))
    return payments.join(lines, keys, "left").select(
        "order_id", "payment_sequential", "n", "lines")


@query("join_full_outer", """
    SELECT coalesce(i.order_id, r.order_id) AS order_id, items, reviews
    FROM item_totals i FULL JOIN review_totals r ON i.order_id = r.order_id""")
def _(w):
    items = w["raw_order_items"].groupBy("order_id").agg(F.count(lit(1)).alias("items"))
    reviews = w["raw_order_reviews"].groupBy("order_id").agg(F.count(lit(1)).alias("reviews"))
    return items.join(reviews, "order_id", "full")


@query("join_cross_one_row", """
    SELECT order_id, date_diff('day', order_purchase_timestamp::DATE, as_of_date)::INT AS age_days
    FROM raw_orders, gold_dataset_dates""")
def _(w):
    as_of = w["gold_dataset_dates"].select("as_of_date").scalar()
    return w["raw_orders"].withColumn("as_of", as_of).select(
        "order_id", F.datediff("as_of", C.purchase_day()).alias("age_days"))


_ENDS = """(SELECT date_trunc('month', order_purchase_timestamp)::DATE AS report_month,
    max(order_purchase_timestamp) AS as_of FROM gold_customer_delivered_orders GROUP BY 1) m"""


@query("join_range_lt", f"""
    SELECT report_month, max(order_purchase_timestamp) AS as_of, count(*) AS rows_before_end
    FROM {_ENDS} JOIN gold_customer_delivered_orders
        ON order_purchase_timestamp < report_month + INTERVAL 1 MONTH GROUP BY 1""")
def _(w):
    return intervals.up_to_month_end(
        w["gold_customer_delivered_orders"], "order_purchase_timestamp")


@query("join_interval_window", f"""
    SELECT report_month, as_of, count(*) AS rows_in_window,
        count(DISTINCT customer_unique_id) AS members_in_window
    FROM {_ENDS} JOIN gold_customer_delivered_orders
        ON order_purchase_timestamp > as_of - INTERVAL 3 MONTH
        AND order_purchase_timestamp <= as_of GROUP BY 1, 2""")
def _(w):
    return intervals.in_window(
        w["gold_customer_delivered_orders"], "order_purchase_timestamp", "customer_unique_id", 3)


@query("join_interval_before", f"""
    SELECT report_month, count(DISTINCT customer_unique_id) AS members_before
    FROM {_ENDS} LEFT JOIN gold_customer_delivered_orders
        ON order_purchase_timestamp <= as_of - INTERVAL 6 MONTH GROUP BY 1""")
def _(w):
    return intervals.before_window(
        w["gold_customer_delivered_orders"], "order_purchase_timestamp", "customer_unique_id", 6)


@query("join_semi_in_subquery", """
    SELECT order_id, order_item_id, product_id FROM raw_order_items
    WHERE order_id IN (SELECT order_id FROM raw_orders WHERE order_status = 'canceled')""")
def _(w):
    canceled = w["raw_orders"].filter("order_status = 'canceled'").select("order_id")
    return w["raw_order_items"].join(canceled, "order_id", "left_semi").select(
        "order_id", "order_item_id", "product_id")


@query("join_anti_orphans", """
    SELECT order_id FROM raw_orders WHERE order_id NOT IN (SELECT order_id FROM raw_order_items)""")
def _(w):
    return w["raw_orders"].join(
        w["raw_order_items"].select("order_id").distinct(), "order_id", "left_anti"
    ).select("order_id")


@query("join_exists_flag", """
    SELECT CASE WHEN EXISTS (SELECT 1 FROM raw_order_items WHERE freight_value IS NULL)
        THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS rows_checked FROM raw_order_items""")
def _(w):
    items = w["raw_order_items"]
    found = items.filter("freight_value IS NULL").limit(1).agg(F.count(lit(1)).alias("n"))
    return items.agg(F.count(lit(1)).alias("rows_checked")).select(
        F.when(found.scalar() > 0, "FAIL").otherwise("PASS").alias("status"), "rows_checked")


@query("join_scalar_subquery", """
    SELECT order_status, count(*) AS orders, (SELECT count(*) FROM raw_orders) AS all_orders
    FROM raw_orders GROUP BY 1""")
def _(w):
    orders = w["raw_orders"]
    total = orders.agg(F.count(lit(1)).alias("n"))
    return orders.groupBy("order_status").agg(F.count(lit(1)).alias("orders")).withColumn(
        "all_orders", total.scalar())


@query("join_preagg_fanout_safe", """
    SELECT order_id, order_item_count, order_gmv, payment_row_count, order_payment_total,
        order_review_count FROM gold_fact_orders""", "order_gmv order_payment_total")
def _(w):
    return w.order_facts().select(
        "order_id", "order_item_count", "order_gmv", "payment_row_count",
        "order_payment_total", "order_review_count")


@query("join_topn_detail", """
    SELECT t.order_id, payment_sequential, payment_value, items AS item_count,
        gmv AS items_amount
    FROM (SELECT * FROM raw_order_payments ORDER BY payment_value DESC NULLS LAST, order_id,
            payment_sequential, payment_type, payment_installments LIMIT 10) t
    LEFT JOIN item_totals i ON i.order_id = t.order_id""", "payment_value items_amount")
def _(w):
    top = quality.payment_top_vs_items(w["raw_order_payments"], w["raw_order_items"], 10)
    return top.select("order_id", "payment_sequential", "payment_value", "item_count",
                      "items_amount")


@query("join_spine_left", """
    SELECT date_day AS day, coalesce(total_orders, 0) AS orders FROM gold_dim_date
    LEFT JOIN dash_kpi_daily ON report_date = date_day""")
def _(w):
    spine = w["gold_dim_date"].select(col("date_day").alias("day"))
    daily = w["dash_kpi_daily"].select(col("report_date").alias("day"),
                                       col("total_orders").alias("orders"))
    return spine.join(daily, "day", "left").fillna(0, ["orders"])


# --- aggregates --------------------------------------------------------------


@query("agg_group_basic", """
    SELECT order_id, count(*) AS n, sum(price) AS total, sum(price)::DOUBLE / count(price) AS mean,
        min(price) AS least, max(price) AS most FROM raw_order_items GROUP BY 1""",
       "total least most")
def _(w):
    price = col("price")
    return w["raw_order_items"].groupBy("order_id").agg(
        F.count(lit(1)).alias("n"), F.sum(price).alias("total"),
        (F.sum(price).cast("double") / F.count(price)).alias("mean"),
        F.min(price).alias("least"), F.max(price).alias("most"))


@query("agg_global", """
    SELECT min(order_purchase_timestamp) AS first_ts, max(order_purchase_timestamp) AS last_ts,
        count(*) AS n FROM raw_orders""")
def _(w):
    ts = "order_purchase_timestamp"
    return w["raw_orders"].agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                               F.count(lit(1)).alias("n"))


@query("agg_count_nonnull", """
    SELECT seller_id, count(*) AS n, count(freight_value) AS with_freight
    FROM raw_order_items GROUP BY 1""")
def _(w):
    return w["raw_order_items"].groupBy("seller_id").agg(
        F.count(lit(1)).alias("n"), F.count("freight_value").alias("with_freight"))


@query("agg_count_distinct", """
    SELECT seller_id, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products
    FROM raw_order_items GROUP BY 1""")
def _(w):
    return w["raw_order_items"].groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("product_id").alias("products"))


@query("agg_count_distinct_row", """
    SELECT count(*) AS keys FROM (SELECT DISTINCT order_item_id, freight_value
    FROM raw_order_items) d""")
def _(w):
    return w["raw_order_items"].agg(
        F.countDistinct(F.struct("order_item_id", "freight_value")).alias("keys"))


@query("agg_filter_clause", """
    SELECT seller_id, count(*) FILTER (price > 50000) AS pricey,
        count(DISTINCT order_id) FILTER (freight_value IS NULL) AS orders_without_freight,
        min(price) FILTER (order_item_id = 1) AS least_first
    FROM raw_order_items GROUP BY 1""", "least_first")
def _(w):
    return w["raw_order_items"].groupBy("seller_id").agg(
        F.count_if(col("price") > 50000).alias("pricey"),
        F.countDistinct(F.when(col("freight_value").isNull(), col("order_id")))
        .alias("orders_without_freight"),
        F.min(F.when(col("order_item_id") == 1, col("price"))).alias("least_first"))


@query("agg_bool_or", """
    SELECT order_id, bool_or(payment_installments > 1) AS split
    FROM raw_order_payments GROUP BY 1""")
def _(w):
    return w["raw_order_payments"].groupBy("order_id").agg(
        F.bool_or(col("payment_installments") > 1).alias("split"))


@query("agg_mode", """
    SELECT geolocation_zip_code_prefix AS zip,
        mode() WITHIN GROUP (ORDER BY geolocation_city) AS city FROM raw_geolocation GROUP BY 1""")
def _(w):
    zips = modes.grouped_modes(
        w["raw_geolocation"], ["geolocation_zip_code_prefix"], ["geolocation_city"])
    return zips.select(col("geolocation_zip_code_prefix").alias("zip"),
                       col("geolocation_city").alias("city"))


@query("agg_percentile_cont", """
    SELECT quantile_cont(price::DOUBLE, 0.5) AS median, quantile_cont(price::DOUBLE, 0.9) AS p90,
        quantile_cont(price::DOUBLE, 0.95) AS p95, quantile_cont(price::DOUBLE, 0.99) AS p99
    FROM raw_order_items""")
def _(w):
    return rank.quantiles(w["raw_order_items"], col("price"),
                          {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99})


@query("agg_having", """
    SELECT order_id, order_item_id, count(*) AS n FROM raw_order_items GROUP BY 1, 2
    HAVING count(*) > 1""")
def _(w):
    return w["raw_order_items"].groupBy("order_id", "order_item_id").agg(
        F.count(lit(1)).alias("n")).filter("n > 1")


@query("agg_nested", """
    SELECT n AS lines, count(*) AS orders FROM (SELECT order_id, count(*) AS n
    FROM raw_order_items GROUP BY 1) o GROUP BY 1""")
def _(w):
    return w["raw_order_items"].groupBy("order_id").agg(F.count(lit(1)).alias("lines")).groupBy(
        "lines").agg(F.count(lit(1)).alias("orders"))


@query("agg_distinct_rows", """
    SELECT DISTINCT customer_unique_id, customer_city, customer_state FROM raw_customers""")
def _(w):
    return w["raw_customers"].select(
        "customer_unique_id", "customer_city", "customer_state").distinct()


@query("agg_ratio_guarded", """
    SELECT seller_id, CASE WHEN count(freight_value) > 0
        THEN sum(freight_value)::DOUBLE / count(freight_value) END AS mean_freight
    FROM raw_order_items GROUP BY 1""")
def _(w):
    return w["raw_order_items"].groupBy("seller_id").agg(
        C.ratio(F.sum("freight_value"), F.count("freight_value")).alias("mean_freight"))


@query("agg_rate_pct", """
    SELECT payment_type, round(100.0 * count(*) FILTER (payment_installments > 1) / count(*), 2)
        AS split_pct FROM raw_order_payments GROUP BY 1""")
def _(w):
    return w["raw_order_payments"].groupBy("payment_type").agg(
        C.pct2(F.count_if(col("payment_installments") > 1), F.count(lit(1))).alias("split_pct"))


@query("agg_value_counts", """
    SELECT product_category_name, count(*) AS products,
        count(*) / (SELECT count(*) FROM raw_products) AS pct FROM raw_products GROUP BY 1""")
def _(w):
    return explore.value_counts(w["raw_products"], "product_category_name", "products")


_REVIEW = ["review_id", "review_comment_title", "review_comment_message"]


@query("agg_null_rate", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) / count(*) AS null_rate "
    "FROM raw_order_reviews" for c in _REVIEW))
def _(w):
    return explore.null_rates(w["raw_order_reviews"], _REVIEW)


@query("agg_describe", """
    SELECT count(price) AS count, count(DISTINCT price) AS unique,
        sum(price)::DOUBLE / count(price) AS mean, round(stddev_samp(price::DOUBLE), 3) AS std,
        min(price) AS min, quantile_cont(price::DOUBLE, 0.25) AS p25,
        quantile_cont(price::DOUBLE, 0.5) AS p50, quantile_cont(price::DOUBLE, 0.75) AS p75,
        max(price) AS max FROM raw_order_items""", "min max")
def _(w):
    return explore.describe_amount(w["raw_order_items"], "price")


@query("agg_nunique", """
    SELECT product_id, count(DISTINCT seller_id) AS sellers FROM raw_order_items GROUP BY 1""")
def _(w):
    return w["raw_order_items"].groupBy("product_id").agg(
        F.countDistinct("seller_id").alias("sellers"))


@query("agg_first", """
    SELECT product_id, any_value(product_category_label) AS category_label, count(*) AS lines
    FROM gold_fact_order_items GROUP BY 1""")
def _(w):
    return w["gold_fact_order_items"].groupBy("product_id").agg(
        F.any_value("product_category_label").alias("category_label"),
        F.count(lit(1)).alias("lines"))


@query("agg_pivot", "SELECT report_month, " + ", ".join(
    f"max(repeat_purchase_rate) FILTER (metric_code = '{c}') AS {c}" for c in RETENTION_CODES)
    + " FROM dash_retention_monthly GROUP BY 1")
def _(w):
    return w["dash_retention_monthly"].groupBy("report_month").pivot(
        "metric_code", RETENTION_CODES).agg(F.first("repeat_purchase_rate"))


# --- windows -----------------------------------------------------------------


@query("win_ntile_global", """
    SELECT customer_unique_id, ntile(5) OVER (ORDER BY monetary_gmv, customer_unique_id)::INT
        AS tile FROM customer_metrics""")
def _(w):
    people = rank.settled(explore.customer_gmv(w["gold_fact_orders"]), "customer-gmv")
    return rank.with_ntile(
        people, "tile", 5, [col("customer_gmv"), col("customer_unique_id")]
    ).select("customer_unique_id", "tile")


@query("win_rownumber_over_agg", """
    SELECT order_purchase_month AS month, product_category_label AS label,
        sum(line_gmv) AS gmv, row_number() OVER (PARTITION BY order_purchase_month
            ORDER BY sum(line_gmv) DESC, product_category_label)::INT AS place
    FROM gold_fact_order_items WHERE is_delivered GROUP BY 1, 2""", "gmv")
def _(w):
    sums = w["gold_fact_order_items"].filter("is_delivered").groupBy(
        col("order_purchase_month").alias("month"),
        col("product_category_label").alias("label"),
    ).agg(F.sum("line_gmv").alias("gmv"))
    # A month has one row per category here.
    order = Window.partitionBy("month").orderBy(col("gmv").desc_nulls_last(), "label")
    return sums.withColumn("place", F.row_number().over(order))


def _state_days(w):
    """Daily delivered GMV per state: a short series per key."""
    places = w["raw_customers"].select("customer_id", "customer_state")
    return w.order_facts().filter("is_delivered").join(places, "customer_id").groupBy(
        "customer_state", "order_purchase_date").agg(F.sum("order_gmv").alias("gmv"))


_DAYS = """(SELECT customer_state, order_purchase_date, sum(order_gmv) AS gmv
    FROM gold_fact_orders JOIN raw_customers USING (customer_id) WHERE is_delivered
    GROUP BY 1, 2) d"""
_SERIES = "PARTITION BY customer_state ORDER BY order_purchase_date"


def _series():
    return Window.partitionBy("customer_state").orderBy("order_purchase_date")


@query("win_lag", f"""
    SELECT customer_state, order_purchase_date, lag(gmv, 1) OVER s AS lag_1,
        lag(gmv, 7) OVER s AS lag_7 FROM {_DAYS} WINDOW s AS ({_SERIES})""", "lag_1 lag_7")
def _(w):
    return _state_days(w).select(
        "customer_state", "order_purchase_date", F.lag("gmv", 1).over(_series()).alias("lag_1"),
        F.lag("gmv", 7).over(_series()).alias("lag_7"))


@query("win_rolling_mean_past", f"""
    SELECT customer_state, order_purchase_date,
        CASE WHEN count(*) OVER s = 7 THEN (sum(gmv) OVER s)::DOUBLE / 7 END AS mean_7
    FROM {_DAYS} WINDOW s AS ({_SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def _(w):
    amount = col("gmv").cast("decimal(18,2)")
    return _state_days(w).select(
        "customer_state", "order_purchase_date",
        C.past_average(amount, _series(), 7).alias("mean_7"))


@query("win_rolling_std_past", f"""
    SELECT customer_state, order_purchase_date,
        round(CASE WHEN count(*) OVER s = 3 THEN stddev_samp(gmv::DOUBLE) OVER s END, 3) AS std_3
    FROM {_DAYS} WINDOW s AS ({_SERIES} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")
def _(w):
    amount = col("gmv").cast("decimal(18,2)")
    return _state_days(w).select(
        "customer_state", "order_purchase_date",
        F.round(C.past_stddev(amount, _series(), 3), 3).alias("std_3"))


@query("win_row_index", """
    SELECT date_day, row_number() OVER (ORDER BY date_day) - 1 AS trend FROM gold_dim_date""")
def _(w):
    days = w["gold_dim_date"].select("date_day")
    first = days.agg(F.min("date_day").alias("d"))
    return days.withColumn("first", first.scalar()).select(
        "date_day", F.datediff("date_day", "first").cast("long").alias("trend"))


@query("win_cumsum_share", """
    SELECT order_id, (sum(paid) OVER o)::DOUBLE / (sum(paid) OVER ())::DOUBLE AS share,
        row_number() OVER o / count(*) OVER () AS place
    FROM payment_totals WINDOW o AS (ORDER BY paid DESC, order_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(w):
    paid = w["raw_order_payments"].groupBy("order_id").agg(
        F.sum("payment_value").alias("paid"))
    running = rank.with_running(paid, [-col("paid"), col("order_id")], col("paid"))
    return running.select(
        "order_id", (col("running").cast("double") / col("total").cast("double")).alias("share"),
        (col("position").cast("double") / col("n")).alias("place"))


@query("win_rank_desc", """
    SELECT category, total, row_number() OVER (ORDER BY total DESC, category)::INT AS rank
    FROM (SELECT category, sum(category_gmv) AS total FROM dash_category_monthly
          GROUP BY 1) c""", "total")
def _(w):
    sums = w["dash_category_monthly"].groupBy("category").agg(
        F.sum("category_gmv").alias("total"))
    sums = sums.withColumnRenamed("total", "amount")  # the running total has that name
    placed = rank.with_running(sums, [-col("amount"), col("category")], col("amount"))
    return placed.select("category", col("amount").alias("total"),
                         col("position").cast("int").alias("rank"))


# --- sorts, limits -----------------------------------------------------------


@query("sort_multi", """
    SELECT report_month, category_rank, category FROM dash_category_monthly
    ORDER BY report_month DESC, category_rank""")
def _(w):
    return w["dash_category_monthly"].select("report_month", "category_rank", "category").orderBy(
        col("report_month").desc_nulls_first(), col("category_rank").asc_nulls_last())


@query("topk_global", """
    SELECT order_id, order_gmv FROM gold_fact_orders
    ORDER BY order_gmv DESC NULLS LAST, order_id LIMIT 50""", "order_gmv")
def _(w):
    return w.order_facts().select("order_id", "order_gmv").orderBy(
        col("order_gmv").desc_nulls_last(), "order_id").limit(50)


@query("topk_per_group", """
    SELECT report_month, category, category_gmv, category_rank FROM dash_category_monthly
    WHERE category_rank <= 3""", "category_gmv")
def _(w):
    return w["dash_category_monthly"].filter("category_rank <= 3").select(
        "report_month", "category", "category_gmv", "category_rank")


@query("limit_one_probe", """
    SELECT count(*) AS found FROM (SELECT 1 FROM raw_order_payments
    WHERE payment_installments = 0 LIMIT 1) p""")
def _(w):
    return w["raw_order_payments"].filter("payment_installments = 0").limit(1).agg(
        F.count(lit(1)).alias("found"))


@query("head_tail", """
    SELECT * FROM (SELECT report_date, gmv FROM dash_kpi_daily ORDER BY report_date DESC LIMIT 90)
    UNION ALL
    SELECT * FROM (SELECT report_date, gmv FROM dash_kpi_daily ORDER BY report_date LIMIT 10)""",
       "gmv")
def _(w):
    days = w["dash_kpi_daily"].select("report_date", "gmv")
    last = days.orderBy(col("report_date").desc()).limit(90)
    return last.unionByName(days.orderBy("report_date").limit(10))


@query("sort_custom_order", """
    SELECT list_position(['shipped', 'delivered', 'canceled'], order_status)::INT AS place,
        order_status, count(*) AS orders FROM raw_orders GROUP BY 1, 2 ORDER BY 1""")
def _(w):
    wanted = F.array(lit("shipped"), lit("delivered"), lit("canceled"))
    return w["raw_orders"].groupBy("order_status").agg(F.count(lit(1)).alias("orders")).select(
        F.array_position(wanted, col("order_status")).cast("int").alias("place"),
        "order_status", "orders").orderBy("place")


# --- sets --------------------------------------------------------------------


@query("set_union_all", """
    SELECT 'item' AS kind, order_id FROM raw_order_items
    UNION ALL SELECT 'payment', order_id FROM raw_order_payments""")
def _(w):
    return union([
        w["raw_order_items"].select(lit("item").alias("kind"), "order_id"),
        w["raw_order_payments"].select(lit("payment").alias("kind"), "order_id"),
    ])


@query("set_union_distinct", """
    SELECT order_id FROM raw_order_items UNION SELECT order_id FROM raw_order_reviews""")
def _(w):
    return w["raw_order_items"].select("order_id").union(
        w["raw_order_reviews"].select("order_id")).distinct()


@query("set_append_row", """
    SELECT report_date, gmv, FALSE AS is_next FROM dash_kpi_daily
    UNION ALL SELECT max(report_date) + 1, NULL, TRUE FROM dash_kpi_daily""", "gmv")
def _(w):
    days = w["dash_kpi_daily"].select("report_date", "gmv", lit(False).alias("is_next"))
    following = days.agg(F.date_add(F.max("report_date"), 1).alias("report_date")).select(
        "report_date", lit(None).cast("decimal(18,2)").alias("gmv"), lit(True).alias("is_next"))
    return days.unionByName(following)


# --- scalar functions --------------------------------------------------------


@query("fn_string", f"""
    SELECT product_id, {label("product_category_name_english")} AS label
    FROM silver_products""")
def _(w):
    return w["silver_products"].select(
        "product_id", C.title_label(col("product_category_name_english")).alias("label"))


@query("fn_concat", """
    SELECT order_id, 'Q' || quarter(order_purchase_timestamp) AS quarter_label,
        'last_' || month(order_purchase_timestamp) || 'm_orders' AS code FROM raw_orders""")
def _(w):
    ts = col("order_purchase_timestamp")
    return w["raw_orders"].select(
        "order_id", F.concat(lit("Q"), F.quarter(ts)).alias("quarter_label"),
        F.format_string("last_%dm_orders", F.month(ts)).alias("code"))


@query("fn_date_parts", """
    SELECT order_id, year(ts)::INT AS y, quarter(ts)::INT AS q, month(ts)::INT AS m,
        weekofyear(ts)::INT AS iso_week, isodow(ts)::INT AS iso_day
    FROM (SELECT order_id, order_purchase_timestamp AS ts FROM raw_orders) o""")
def _(w):
    ts = col("order_purchase_timestamp")
    return w["raw_orders"].select(
        "order_id", F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"),
        F.weekofyear(ts).alias("iso_week"), (F.weekday(ts) + 1).alias("iso_day"))


@query("fn_date_format", """
    SELECT review_id, strftime(ts, '%Y%m%d') AS ymd, strftime(ts, '%Y-%m') AS ym,
        strftime(ts, '%B %b') AS month_names, strftime(ts, '%A %a') AS day_names
    FROM (SELECT review_id, review_creation_date AS ts FROM raw_order_reviews) r""")
def _(w):
    ts = "review_creation_date"
    return w["raw_order_reviews"].select(
        "review_id", F.date_format(ts, "yyyyMMdd").alias("ymd"),
        F.date_format(ts, "yyyy-MM").alias("ym"),
        F.date_format(ts, "MMMM MMM").alias("month_names"),
        F.date_format(ts, "EEEE E").alias("day_names"))


@query("fn_date_trunc", """
    SELECT review_id, review_creation_date::DATE AS day,
        date_trunc('month', review_creation_date)::DATE AS month_start FROM raw_order_reviews""")
def _(w):
    day = col("review_creation_date").cast("date")
    return w["raw_order_reviews"].select(
        "review_id", day.alias("day"), C.month_start(day).alias("month_start"))


@query("fn_date_arith", """
    SELECT order_id, order_purchase_timestamp - INTERVAL 3 MONTH AS earlier,
        order_purchase_timestamp::DATE + 1 AS next_day,
        date_diff('day', order_purchase_timestamp::DATE, order_estimated_delivery_date::DATE)::INT
            AS promised_days FROM raw_orders""")
def _(w):
    ts = col("order_purchase_timestamp")
    return w["raw_orders"].select(
        "order_id", C.months_before(ts, 3).alias("earlier"),
        F.date_add(C.purchase_day(), 1).alias("next_day"),
        F.datediff("order_estimated_delivery_date", ts).alias("promised_days"))


@query("fn_math", """
    SELECT order_id, order_item_id, product_id, abs(price - 50000) AS gap,
        round(price, 0)::DOUBLE AS rounded, price <> trunc(price) AS has_cents,
        sqrt(price::DOUBLE) AS root FROM raw_order_items""", "gap")
def _(w):
    price = col("price")
    return w["raw_order_items"].select(
        "order_id", "order_item_id", "product_id", F.abs(price - 50000).alias("gap"),
        F.round(price, 0).cast("double").alias("rounded"),
        (price != F.floor(price)).alias("has_cents"),
        F.sqrt(price.cast("double")).alias("root"))


@query("fn_seasonal", """
    SELECT order_id, round(sin(2 * pi() * m / 12), 9) + 0.0 AS month_sin,
        round(cos(2 * pi() * m / 12), 9) + 0.0 AS month_cos
    FROM (SELECT order_id, month(order_purchase_timestamp) AS m FROM raw_orders) o""")
def _(w):
    turn = F.pi() * 2 * F.month("order_purchase_timestamp") / 12
    return w["raw_orders"].select(
        "order_id", (F.round(F.sin(turn), 9) + 0.0).alias("month_sin"),
        (F.round(F.cos(turn), 9) + 0.0).alias("month_cos"))


@query("fn_clip", """
    SELECT order_id, CASE WHEN order_gmv <> 0 THEN least(greatest(
            order_payment_total::DOUBLE / order_gmv::DOUBLE, 0.0), 1.0) END AS paid_share,
        greatest(0.0, order_gmv::DOUBLE - 100000) AS above FROM gold_fact_orders""")
def _(w):
    share = col("order_payment_total").cast("double") / F.nullif(
        col("order_gmv").cast("double"), lit(0.0))
    return w.order_facts().select(
        "order_id",
        F.when(share.isNotNull(), F.least(F.greatest(share, lit(0.0)), lit(1.0)))
        .alias("paid_share"),
        F.greatest(lit(0.0), col("order_gmv").cast("double") - 100000).alias("above"))


@query("fn_period", """
    SELECT order_status, (date_trunc('month', max(order_purchase_timestamp))
        - INTERVAL 2 MONTH)::DATE AS test_start FROM raw_orders GROUP BY 1""")
def _(w):
    return w["raw_orders"].groupBy("order_status").agg(F.max(C.purchase_day()).alias("d")).select(
        "order_status", F.add_months(C.month_start(col("d")), -2).alias("test_start"))


@query("fn_scale", """
    SELECT report_month, gmv::DOUBLE / 1000000 AS gmv_million,
        printf('%.1f%%', 100 * delivery_delay_rate) AS delay_text FROM dash_kpi_monthly
    WHERE delivery_delay_rate IS NOT NULL""")
def _(w):
    return w["dash_kpi_monthly"].filter("delivery_delay_rate IS NOT NULL").select(
        "report_month", (col("gmv").cast("double") / 1_000_000).alias("gmv_million"),
        F.format_string("%.1f%%", col("delivery_delay_rate") * 100).alias("delay_text"))


@query("fn_run_id", """
    SELECT order_status, count(*) AS orders, 1::BIGINT AS run_ids, 32::INT AS id_length,
        1::BIGINT AS moments FROM raw_orders GROUP BY 1""")
def _(w):
    run_id, moment = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc)
    tagged = w["raw_orders"].withColumn("run_id", lit(run_id)).withColumn(
        "generated_at", lit(moment))
    return tagged.groupBy("order_status").agg(
        F.count(lit(1)).alias("orders"), F.countDistinct("run_id").alias("run_ids"),
        F.max(F.length("run_id")).alias("id_length"),
        F.countDistinct("generated_at").alias("moments"))
