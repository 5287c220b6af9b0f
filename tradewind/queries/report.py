"""Report measures."""

from __future__ import annotations

from tradewind.operators import report as R
from tradewind.queries import query

_CARDS = """(SELECT order_purchase_month AS period_start, sum(order_gmv)::DOUBLE AS gmv,
        count(DISTINCT order_id) AS total_orders,
        sum(order_gmv)::DOUBLE / count(DISTINCT order_id) AS aov,
        count(DISTINCT customer_unique_id) AS unique_customers,
        any_value(again) / count(DISTINCT customer_unique_id) AS repeat_rate
    FROM gold_fact_orders JOIN (
        SELECT order_purchase_month, count(*) FILTER (n > 1) AS again FROM (
            SELECT order_purchase_month, customer_unique_id, count(DISTINCT order_id) AS n
            FROM gold_fact_orders WHERE is_delivered GROUP BY ALL) p GROUP BY 1) q
        USING (order_purchase_month)
    WHERE is_delivered GROUP BY 1)"""
_YOY = ", ".join(f"CASE WHEN b.{c} > 0 THEN (a.{c} - b.{c}) / b.{c} END AS {c}_yoy"
                 for c in R.CARDS)


@query("bi_kpi_cards_yoy", f"""
    SELECT a.*, {_YOY} FROM {_CARDS} a
    LEFT JOIN {_CARDS} b ON b.period_start = a.period_start - INTERVAL 12 MONTH""")
def _(w):
    return R.kpi_cards_yoy(w["gold_fact_orders"])


@query("bi_time_slicer", """
    SELECT year, quarter_label, sum(order_gmv) AS gmv, count(DISTINCT order_id) AS total_orders,
        sum(order_payment_total) AS actual_payment, count(*) FILTER (is_delayed) AS delayed_orders,
        count(*) FILTER (is_valid_for_delivery_delay_kpi) AS judged_orders,
        sum(order_gmv)::DOUBLE / count(DISTINCT order_id) AS aov,
        CASE WHEN count(*) FILTER (is_valid_for_delivery_delay_kpi) > 0 THEN
            count(*) FILTER (is_delayed) / count(*) FILTER (is_valid_for_delivery_delay_kpi) END
            AS delivery_delay_rate
    FROM gold_fact_orders JOIN gold_dim_date ON date_day = order_purchase_date
    WHERE is_delivered GROUP BY year, quarter_label""", "gmv actual_payment")
def _(w):
    return R.time_slicer(w.order_facts(), w["gold_dim_date"], ["year", "quarter_label"])


@query("bi_top_categories", """
    SELECT customer_state, product_category_name_english AS category, sum(line_gmv) AS gmv,
        count(DISTINCT order_id) AS orders,
        row_number() OVER (PARTITION BY customer_state ORDER BY sum(line_gmv) DESC,
            product_category_name_english NULLS FIRST)::INT AS place
    FROM gold_fact_order_items JOIN gold_dim_customer USING (customer_id)
    WHERE is_delivered GROUP BY 1, 2 QUALIFY place <= 3""", "gmv")
def _(w):
    return R.top_categories(w["gold_fact_order_items"], w["gold_dim_customer"])


@query("bi_geo_gmv", """
    SELECT customer_state, customer_city, sum(order_gmv) AS gmv,
        count(DISTINCT order_id) AS orders,
        sum(customer_geo_lat::DECIMAL(20,10))::DOUBLE / count(customer_geo_lat) AS lat,
        sum(customer_geo_lng::DECIMAL(20,10))::DOUBLE / count(customer_geo_lng) AS lng
    FROM gold_fact_orders JOIN gold_dim_customer USING (customer_id)
    WHERE is_delivered GROUP BY 1, 2""", "gmv")
def _(w):
    return R.geo_gmv(w.order_facts(), w["gold_dim_customer"])


@query("bi_geo_review_score", """
    SELECT customer_state, count(review_score) AS reviews, avg(review_score) AS avg_review_score
    FROM gold_fact_order_reviews JOIN gold_dim_customer USING (customer_id) GROUP BY 1""")
def _(w):
    return R.geo_review_score(w["gold_fact_order_reviews"], w["gold_dim_customer"])


@query("bi_payment_mix", """
    SELECT payment_type, sum(payment_value) AS payment_value, count(*) AS payment_rows,
        sum(payment_value)::DOUBLE / (SELECT sum(payment_value)::DOUBLE
            FROM gold_fact_order_payments WHERE is_delivered) AS value_share
    FROM gold_fact_order_payments WHERE is_delivered GROUP BY 1""", "payment_value")
def _(w):
    return R.payment_mix(w["gold_fact_order_payments"])


@query("bi_freight_cost", """
    SELECT order_purchase_month AS report_month, coalesce(sum(freight_value), 0) AS freight,
        sum(line_gmv) AS gmv,
        coalesce(sum(freight_value), 0)::DOUBLE / sum(line_gmv)::DOUBLE AS freight_share
    FROM gold_fact_order_items WHERE is_delivered GROUP BY 1""", "freight gmv")
def _(w):
    return R.freight_cost(w["gold_fact_order_items"])


@query("bi_delay_vs_repeat", """
    SELECT is_delayed AS first_order_delayed, count(*) AS customers,
        count(*) FILTER (n > 1) AS repeat_customers,
        sum(order_avg_review_score::DECIMAL(12,8))::DOUBLE / count(order_avg_review_score)
            AS avg_first_review_score, count(*) FILTER (n > 1) / count(*) AS repeat_rate
    FROM (SELECT *, count(*) OVER (PARTITION BY customer_unique_id) AS n,
            row_number() OVER (PARTITION BY customer_unique_id
                ORDER BY order_purchase_timestamp, order_id) AS place
          FROM gold_fact_orders WHERE is_delivered) o
    WHERE place = 1 AND is_valid_for_delivery_delay_kpi GROUP BY 1""")
def _(w):
    return R.delay_vs_repeat(w["gold_fact_orders"])
