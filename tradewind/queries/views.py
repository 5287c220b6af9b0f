"""Comparison SQL: common table expressions for every warehouse table.

Written independently of the Spark plans, in the plainest form that gives the
result (item-level sums, range joins, unpartitioned windows).
"""

from __future__ import annotations

import re

from tradewind.sources import standins

_DELIVERED = "order_status = 'delivered'"
_LABEL = """array_to_string(list_transform(string_split(replace({0}, '_', ' '), ' '),
    lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"""
_PURCHASE = """order_purchase_timestamp,
    order_purchase_timestamp::DATE AS order_purchase_date,
    date_trunc('month', order_purchase_timestamp)::DATE AS order_purchase_month"""


def label(column: str) -> str:
    return _LABEL.format(f"coalesce({column}, 'unknown')")


VIEWS: dict[str, str] = {
    **standins.SQL,
    "silver_geolocation": """
        SELECT DISTINCT * FROM raw_geolocation WHERE NOT (geolocation_zip_code_prefix IS NULL
            OR geolocation_lat IS NULL OR geolocation_lng IS NULL
            OR geolocation_city IS NULL OR geolocation_state IS NULL)""",
    "silver_products": """
        SELECT p.product_id, p.product_category_name,
            coalesce(t.product_category_name_english, 'Unknown') AS product_category_name_english,
            p.* EXCLUDE (product_id, product_category_name),
            p.product_category_name IS NOT NULL AND t.product_category_name IS NULL
                AS missing_translation_flag
        FROM raw_products p LEFT JOIN raw_category_translation t USING (product_category_name)""",
    "silver_orders": f"""
        SELECT *, {_DELIVERED} AND order_delivered_customer_date IS NULL
            AS is_delivery_inconsistency FROM raw_orders""",
    "gold_dataset_dates": f"""
        SELECT max(order_purchase_timestamp)::DATE AS as_of_date,
            max(order_purchase_timestamp) AS as_of_timestamp
        FROM silver_orders WHERE {_DELIVERED}""",
    "gold_dim_date": """
        SELECT d AS date_day, strftime(d, '%Y%m%d')::INT AS date_key, year(d)::INT AS year,
            quarter(d)::INT AS quarter, 'Q' || quarter(d) AS quarter_label,
            month(d)::INT AS month, strftime(d, '%B') AS month_name,
            strftime(d, '%b') AS month_short_name, strftime(d, '%Y-%m') AS year_month,
            strftime(d, '%Y%m')::INT AS year_month_key,
            date_trunc('month', d)::DATE AS month_start_date,
            weekofyear(d)::INT AS week_of_year, isodow(d)::INT AS day_of_week,
            strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_short_name,
            isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(min(order_purchase_timestamp)::DATE,
                max(order_purchase_timestamp)::DATE, INTERVAL 1 DAY))::DATE AS d
              FROM silver_orders) s""",
    "zip_places": """
        SELECT geolocation_zip_code_prefix AS customer_zip_code_prefix,
            sum(geolocation_lat)::DOUBLE / count(*) AS customer_geo_lat,
            sum(geolocation_lng)::DOUBLE / count(*) AS customer_geo_lng,
            mode() WITHIN GROUP (ORDER BY geolocation_city) AS customer_geo_city,
            mode() WITHIN GROUP (ORDER BY geolocation_state) AS customer_geo_state
        FROM silver_geolocation GROUP BY ALL""",
    "gold_dim_customer": """
        SELECT c.*, z.* EXCLUDE (customer_zip_code_prefix)
        FROM raw_customers c LEFT JOIN zip_places z USING (customer_zip_code_prefix)""",
    "gold_dim_unique_customer": f"""
        SELECT customer_unique_id, count(DISTINCT c.customer_id) AS customer_id_count,
            count(DISTINCT order_id) AS order_count,
            count(DISTINCT CASE WHEN {_DELIVERED} THEN order_id END) AS delivered_order_count,
            min(order_purchase_timestamp) AS first_order_purchase_timestamp,
            max(order_purchase_timestamp) AS last_order_purchase_timestamp,
            min(CASE WHEN {_DELIVERED} THEN order_purchase_timestamp END)
                AS first_delivered_order_purchase_timestamp,
            max(CASE WHEN {_DELIVERED} THEN order_purchase_timestamp END)
                AS last_delivered_order_purchase_timestamp,
            mode() WITHIN GROUP (ORDER BY customer_zip_code_prefix) AS customer_zip_code_prefix,
            mode() WITHIN GROUP (ORDER BY customer_city) AS customer_city,
            mode() WITHIN GROUP (ORDER BY customer_state) AS customer_state,
            sum(customer_geo_lat::DECIMAL(20,12))::DOUBLE / count(customer_geo_lat)
                AS customer_geo_lat,
            sum(customer_geo_lng::DECIMAL(20,12))::DOUBLE / count(customer_geo_lng)
                AS customer_geo_lng,
            count(DISTINCT c.customer_id) > 1 AS has_multiple_customer_ids,
            count(DISTINCT customer_zip_code_prefix) > 1 OR count(DISTINCT customer_city) > 1
                OR count(DISTINCT customer_state) > 1 AS has_multiple_locations
        FROM gold_dim_customer c LEFT JOIN silver_orders o ON o.customer_id = c.customer_id
        WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id""",
    "gold_dim_product": f"""
        SELECT product_id, product_category_name, product_category_name_english AS category,
            {label("product_category_name_english")} AS category_label,
            missing_translation_flag, product_name_lenght, product_description_lenght,
            product_photos_qty, product_weight_g, product_weight_g / 1000 AS product_weight_kg,
            product_length_cm, product_height_cm, product_width_cm,
            product_length_cm::DECIMAL(12,2) * product_height_cm::DECIMAL(12,2)
                * product_width_cm::DECIMAL(12,2) AS product_volume_cm3
        FROM silver_products""",
    "item_totals": """
        SELECT order_id, count(*) AS items, sum(price + coalesce(freight_value, 0)) AS gmv
        FROM raw_order_items GROUP BY order_id""",
    "payment_totals": """
        SELECT order_id, count(*) AS payments, sum(payment_value) AS paid,
            max(payment_installments) > 1 AS split
        FROM raw_order_payments GROUP BY order_id""",
    "review_totals": """
        SELECT order_id, count(*) AS reviews, avg(review_score) AS score,
            min(review_creation_date) AS first_review, max(review_creation_date) AS last_review
        FROM raw_order_reviews GROUP BY order_id""",
    "gold_fact_orders": f"""
        SELECT o.order_id, o.customer_id, c.customer_unique_id, order_status, {_PURCHASE},
            order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
            order_estimated_delivery_date, is_delivery_inconsistency,
            {_DELIVERED} AS is_delivered,
            {_DELIVERED} AND NOT is_delivery_inconsistency
                AND order_estimated_delivery_date IS NOT NULL AS is_valid_for_delivery_delay_kpi,
            {_DELIVERED} AND coalesce(
                order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_delayed,
            coalesce(items, 0) AS order_item_count, coalesce(gmv, 0) AS order_gmv,
            coalesce(payments, 0) AS payment_row_count, coalesce(paid, 0) AS order_payment_total,
            coalesce(split, FALSE) AS uses_installments,
            coalesce(reviews, 0) AS order_review_count, score AS order_avg_review_score,
            first_review AS order_first_review_creation_date,
            last_review AS order_last_review_creation_date,
            coalesce(reviews, 0) > 0 AS has_review
        FROM silver_orders o
        LEFT JOIN raw_customers c ON c.customer_id = o.customer_id
        LEFT JOIN item_totals i ON i.order_id = o.order_id
        LEFT JOIN payment_totals p ON p.order_id = o.order_id
        LEFT JOIN review_totals r ON r.order_id = o.order_id""",
    "gold_fact_order_items": f"""
        SELECT i.order_id, order_item_id, i.product_id, seller_id, shipping_limit_date, price,
            freight_value, price + coalesce(freight_value, 0) AS line_gmv,
            o.order_id IS NOT NULL AS has_order, order_status, {_PURCHASE}, customer_id,
            {_DELIVERED} AS is_delivered, is_delivery_inconsistency, product_category_name,
            product_category_name_english,
            {label("product_category_name_english")} AS product_category_label,
            missing_translation_flag
        FROM raw_order_items i
        LEFT JOIN silver_orders o ON o.order_id = i.order_id
        LEFT JOIN silver_products p ON p.product_id = i.product_id""",
    "gold_fact_order_payments": f"""
        SELECT p.*, payment_installments > 1 AS is_installment_payment, customer_id,
            order_status, {_PURCHASE}, {_DELIVERED} AS is_delivered
        FROM raw_order_payments p LEFT JOIN silver_orders o ON o.order_id = p.order_id""",
    "gold_fact_order_reviews": f"""
        SELECT r.*, customer_id, {_PURCHASE}
        FROM raw_order_reviews r JOIN silver_orders o ON o.order_id = r.order_id
        WHERE {_DELIVERED}""",
    "gold_customer_delivered_orders": f"""
        SELECT customer_unique_id, o.customer_id, order_id, order_purchase_timestamp,
            order_purchase_timestamp::DATE AS order_purchase_date
        FROM silver_orders o JOIN raw_customers c ON c.customer_id = o.customer_id
        WHERE {_DELIVERED} AND customer_unique_id IS NOT NULL
            AND order_purchase_timestamp IS NOT NULL""",
    "customer_metrics": """
        SELECT customer_unique_id, max(order_purchase_date) AS last_order_date,
            date_diff('day', max(order_purchase_date),
                (SELECT as_of_date FROM gold_dataset_dates))::INT AS recency_days,
            count(DISTINCT order_id) AS frequency_orders, sum(order_gmv) AS monetary_gmv,
            sum(order_gmv)::DOUBLE / count(DISTINCT order_id) AS avg_order_value
        FROM gold_fact_orders WHERE is_delivered AND customer_unique_id IS NOT NULL
        GROUP BY customer_unique_id""",
    "rfm_scores": """
        SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_unique_id)::INT AS r_score,
            least(frequency_orders, 5)::INT AS f_score,
            ntile(5) OVER (ORDER BY monetary_gmv, customer_unique_id)::INT AS m_score
        FROM customer_metrics""",
    "gold_customer_rfm": """
        SELECT *, 100 * r_score + 10 * f_score + m_score AS rfm_code,
            (5 * r_score + 3 * f_score + 2 * m_score) / 10.0 AS rfm_weighted_score,
            CASE WHEN f_score = 1 THEN
                CASE WHEN r_score <= 2 AND m_score <= 2 THEN 'Hibernating'
                     WHEN r_score <= 2 THEN 'At Risk'
                     WHEN m_score >= 4 THEN 'High-Value Customers'
                     WHEN r_score = 3 THEN 'Other Customers'
                     ELSE 'Recent Customers' END
            ELSE
                CASE WHEN r_score <= 2 THEN 'At Risk'
                     WHEN r_score >= 4 AND m_score >= 4 THEN 'Champions'
                     ELSE 'Loyal Customers' END
            END AS customer_segment
        FROM rfm_scores""",
    "sold_by_month": """
        SELECT order_purchase_month AS report_month, sum(line_gmv) AS gmv,
            count(DISTINCT order_id) AS total_orders
        FROM gold_fact_order_items WHERE is_delivered GROUP BY ALL""",
    "paid_by_month": """
        SELECT order_purchase_month AS report_month, sum(payment_value) AS actual_payment
        FROM gold_fact_order_payments WHERE is_delivered GROUP BY ALL""",
    "reviewed_by_month": """
        SELECT order_purchase_month AS report_month, count(*) AS review_count,
            avg(review_score) AS avg_review_score
        FROM gold_fact_order_reviews GROUP BY ALL""",
    "orders_by_month": """
        SELECT order_purchase_month AS report_month, count(*) AS delivered_orders,
            count(*) FILTER (is_valid_for_delivery_delay_kpi) AS delivery_delay_denominator,
            count(*) FILTER (is_delayed) AS delayed_orders,
            count(*) FILTER (uses_installments) AS installment_orders
        FROM gold_fact_orders WHERE is_delivered AND order_purchase_month IS NOT NULL
        GROUP BY ALL""",
    "dash_kpi_monthly": """
        SELECT report_month, coalesce(gmv, 0) AS gmv, coalesce(total_orders, 0) AS total_orders,
            CASE WHEN total_orders > 0 THEN gmv::DOUBLE / total_orders END AS aov,
            coalesce(actual_payment, 0) AS actual_payment, delivered_orders,
            delivery_delay_denominator, delayed_orders,
            CASE WHEN delivery_delay_denominator > 0
                THEN delayed_orders / delivery_delay_denominator END AS delivery_delay_rate,
            coalesce(review_count, 0) AS review_count, avg_review_score, installment_orders,
            installment_orders / delivered_orders AS installment_usage_rate
        FROM orders_by_month LEFT JOIN sold_by_month USING (report_month)
        LEFT JOIN paid_by_month USING (report_month)
        LEFT JOIN reviewed_by_month USING (report_month)""",
    "dash_kpi_daily": """
        SELECT report_date, coalesce(gmv, 0) AS gmv, coalesce(total_orders, 0) AS total_orders,
            coalesce(actual_payment, 0) AS actual_payment
        FROM (SELECT order_purchase_date AS report_date, sum(line_gmv) AS gmv,
                count(DISTINCT order_id) AS total_orders
              FROM gold_fact_order_items WHERE is_delivered GROUP BY ALL) i
        FULL JOIN (SELECT order_purchase_date AS report_date, sum(payment_value) AS actual_payment
              FROM gold_fact_order_payments WHERE is_delivered GROUP BY ALL) p
        USING (report_date)""",
    "dash_kpi_weekly": """
        SELECT date_trunc('week', report_date)::DATE AS week_start, sum(gmv) AS gmv,
            sum(total_orders)::BIGINT AS total_orders, sum(actual_payment) AS actual_payment
        FROM dash_kpi_daily GROUP BY ALL""",
    "dash_category_monthly": """
        SELECT *, row_number() OVER (PARTITION BY report_month
            ORDER BY category_gmv DESC NULLS FIRST, category NULLS FIRST,
                category_label NULLS FIRST)::INT AS category_rank
        FROM (SELECT order_purchase_month AS report_month,
                product_category_name_english AS category,
                product_category_label AS category_label, sum(line_gmv) AS category_gmv,
                count(DISTINCT order_id) AS category_order_count
              FROM gold_fact_order_items WHERE is_delivered GROUP BY ALL) c""",
    "moments": """
        SELECT report_month, max(order_purchase_timestamp) AS as_of_timestamp
        FROM (SELECT DISTINCT date_trunc('month', order_purchase_timestamp)::DATE AS report_month
              FROM gold_customer_delivered_orders) m
        JOIN gold_customer_delivered_orders
            ON order_purchase_timestamp < report_month + INTERVAL 1 MONTH
        GROUP BY report_month""",
    "person_months": """
        SELECT report_month, as_of_timestamp, customer_unique_id,
            count(DISTINCT order_id) AS ever,
            count(DISTINCT order_id) FILTER (
                order_purchase_timestamp > as_of_timestamp - INTERVAL 3 MONTH) AS in3,
            count(DISTINCT order_id) FILTER (
                order_purchase_timestamp > as_of_timestamp - INTERVAL 6 MONTH) AS in6
        FROM moments JOIN gold_customer_delivered_orders
            ON order_purchase_timestamp <= as_of_timestamp
        GROUP BY ALL""",
    "dash_retention_monthly": """
        SELECT report_month, as_of_timestamp, m.c AS metric_code, m.t AS total_customers,
            m.r AS returning_customers, CASE WHEN m.t > 0 THEN m.r / m.t END
                AS repeat_purchase_rate
        FROM (
            SELECT report_month, as_of_timestamp, unnest([
                {c: 'lifetime_repeat_purchase', t: count(*), r: count(*) FILTER (ever > 1)},
                {c: 'last_3m_returning_customer', t: count(*) FILTER (in3 > 0),
                    r: count(*) FILTER (in3 > 0 AND ever > in3)},
                {c: 'last_6m_returning_customer', t: count(*) FILTER (in6 > 0),
                    r: count(*) FILTER (in6 > 0 AND ever > in6)},
                {c: 'last_3m_repeat_purchase', t: count(*) FILTER (in3 > 0),
                    r: count(*) FILTER (in3 > 1)},
                {c: 'last_6m_repeat_purchase', t: count(*) FILTER (in6 > 0),
                    r: count(*) FILTER (in6 > 1)}
            ]) AS m FROM person_months GROUP BY report_month, as_of_timestamp
        ) x""",
    "dash_retention_snapshot": """
        SELECT as_of_timestamp::DATE AS as_of_date, r.* EXCLUDE (report_month)
        FROM dash_retention_monthly r
        WHERE report_month = (SELECT max(report_month) FROM dash_retention_monthly)""",
    "ml_daily_business_metrics": """
        SELECT order_purchase_date AS order_date, count(DISTINCT order_id) AS orders,
            sum(order_gmv) AS gmv, count(DISTINCT customer_unique_id) AS unique_customers
        FROM gold_fact_orders WHERE is_delivered AND order_purchase_date IS NOT NULL
        GROUP BY ALL""",
}


def _uses(text: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", text)]


def compose(sql: str, money: list[str] = ()) -> str:
    """`sql` with the views it needs in front; `money` columns become double."""
    needed: set[str] = set()
    pending = _uses(sql)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += _uses(VIEWS[name])
    heads = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    body = sql.strip()
    if money:
        casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in money)
        body = f"SELECT * REPLACE ({casts}) FROM ({body}) result"
    return f"WITH {', '.join(heads)} {body}" if heads else body
