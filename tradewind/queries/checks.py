"""KPI tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewind.operators import checks as K
from tradewind.queries import query
from tradewind.queries.quality import UNION


def _grain_sql() -> str:
    parts = []
    for table, (text, keys) in K.GRAINS.items():
        listed = ", ".join(keys)
        some = f"WHERE {keys[0]} IS NOT NULL" if len(keys) == 1 else ""
        parts.append(
            f"SELECT '{table}' AS table_name, '{text}' AS expected_grain, n AS total_rows, "
            "k AS distinct_keys, n - k AS duplicate_rows, "
            "CASE WHEN n = k THEN 'PASS' ELSE 'FAIL' END AS status FROM "
            f"(SELECT count(*) AS n FROM {table}) a, (SELECT count(*) AS k FROM "
            f"(SELECT DISTINCT {listed} FROM {table} {some}) d) b")
    return UNION.join(parts)


@query("test_grain", _grain_sql())
def _(w):
    return K.grain(w)


@query("test_retention_codes", """
    SELECT 'dash_retention_snapshot metric codes' AS check_name, 5::BIGINT AS expected_count,
        count(DISTINCT metric_code) AS actual_count, 5 - count(DISTINCT metric_code)
            AS missing_count,
        CASE WHEN count(DISTINCT metric_code) = 5 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM dash_retention_snapshot
    UNION ALL
    SELECT 'dash_retention_monthly has 5 metric codes per month', 5, min(n),
        count(*) FILTER (n <> 5),
        CASE WHEN bool_and(n = 5) THEN 'PASS' ELSE 'FAIL' END
    FROM (SELECT report_month, count(DISTINCT metric_code) AS n
          FROM dash_retention_monthly GROUP BY 1) m""")
def _(w):
    return K.retention_codes(w["dash_retention_snapshot"], w["dash_retention_monthly"])


# Both computations in SQL: the mart's, and one from the raw rows.
_MONTH = "date_trunc('month', order_purchase_timestamp)::DATE AS report_month"
_RAW_MONTHS = f"""(SELECT o.report_month, i.gmv, coalesce(i.n, 0) AS total_orders,
        i.gmv::DOUBLE / i.n AS aov, p.paid, r.score, d.late / nullif(d.judged, 0) AS late_rate,
        d.split / d.n AS split_rate
    FROM (SELECT {_MONTH} FROM raw_orders WHERE order_status = 'delivered' GROUP BY 1) o
    LEFT JOIN (SELECT {_MONTH}, sum(price + coalesce(freight_value, 0)) AS gmv,
            count(DISTINCT order_id) AS n FROM raw_order_items JOIN raw_orders USING (order_id)
            WHERE order_status = 'delivered' GROUP BY 1) i USING (report_month)
    LEFT JOIN (SELECT {_MONTH}, sum(payment_value) AS paid
            FROM raw_order_payments JOIN raw_orders USING (order_id)
            WHERE order_status = 'delivered' GROUP BY 1) p USING (report_month)
    LEFT JOIN (SELECT {_MONTH}, avg(review_score) AS score
            FROM raw_order_reviews JOIN raw_orders USING (order_id)
            WHERE order_status = 'delivered' GROUP BY 1) r USING (report_month)
    LEFT JOIN (SELECT {_MONTH}, count(*) AS n,
            count(*) FILTER (order_delivered_customer_date IS NOT NULL
                AND order_estimated_delivery_date IS NOT NULL) AS judged,
            count(*) FILTER (order_delivered_customer_date > order_estimated_delivery_date) AS late,
            count(*) FILTER (order_id IN (SELECT order_id FROM raw_order_payments
                WHERE payment_installments > 1)) AS split
            FROM raw_orders WHERE order_status = 'delivered' GROUP BY 1) d USING (report_month))"""


@query("test_monthly_metrics", f"""
    SELECT months_checked, round(g, 6)::DOUBLE AS max_gmv_diff, n::BIGINT AS max_total_orders_diff,
        round(a, 9) AS max_aov_diff, round(p, 6)::DOUBLE AS max_actual_payment_diff,
        round(d, 9) AS max_delivery_delay_rate_diff, round(s, 9) AS max_avg_review_score_diff,
        round(i, 9) AS max_installment_usage_rate_diff,
        CASE WHEN g <= 0.01 AND n = 0 AND a <= 0.000001 AND p <= 0.01 AND d <= 0.000001
            AND s <= 0.000001 AND i <= 0.000001 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT count(*) AS months_checked, max(abs(m.gmv - coalesce(r.gmv, 0))) AS g,
            max(abs(m.total_orders - r.total_orders)) AS n, max(abs(m.aov - r.aov)) AS a,
            max(abs(m.actual_payment - coalesce(r.paid, 0))) AS p,
            max(abs(m.delivery_delay_rate - r.late_rate)) AS d,
            max(abs(m.avg_review_score - r.score)) AS s,
            max(abs(m.installment_usage_rate - r.split_rate)) AS i
          FROM dash_kpi_monthly m JOIN {_RAW_MONTHS} r USING (report_month)) x""")
def _(w):
    again = K.monthly_from_facts(
        w["gold_fact_orders"], w["gold_fact_order_items"], w["gold_fact_order_payments"],
        w["gold_fact_order_reviews"])
    found = K.monthly_metrics(w["dash_kpi_monthly"], again)
    return found.select(*[
        F.round(c, 6 if c in ("max_gmv_diff", "max_actual_payment_diff") else 9).cast("double").alias(c)
        if c.endswith("_diff") and "orders" not in c else c for c in found.columns])


_SETS = """(SELECT 'lifetime_repeat_purchase' AS metric_code, count(*) AS t,
        count(*) FILTER (n > 1) AS r FROM (SELECT count(DISTINCT order_id) AS n
            FROM gold_customer_delivered_orders GROUP BY customer_unique_id) x""" + "".join(f"""
    UNION ALL SELECT 'last_{m}m_repeat_purchase', count(*), count(*) FILTER (n > 1)
        FROM (SELECT count(DISTINCT order_id) AS n FROM gold_customer_delivered_orders,
                gold_dataset_dates WHERE order_purchase_timestamp > as_of_timestamp - INTERVAL {m} MONTH
              GROUP BY customer_unique_id) x
    UNION ALL SELECT 'last_{m}m_returning_customer', count(*), count(*) FILTER (
            customer_unique_id IN (SELECT customer_unique_id FROM gold_customer_delivered_orders,
                gold_dataset_dates
                WHERE order_purchase_timestamp <= as_of_timestamp - INTERVAL {m} MONTH))
        FROM (SELECT DISTINCT customer_unique_id FROM gold_customer_delivered_orders,
                gold_dataset_dates
              WHERE order_purchase_timestamp > as_of_timestamp - INTERVAL {m} MONTH) x"""
    for m in (3, 6)) + ")"


@query("test_retention_metrics", f"""
    SELECT metric_code, d.total_customers AS dash_total_customers,
        t AS recalculated_total_customers, d.returning_customers AS dash_returning_customers,
        r AS recalculated_returning_customers,
        round(abs(d.repeat_purchase_rate - r / nullif(t, 0)), 9) AS rate_diff,
        CASE WHEN d.total_customers = t AND d.returning_customers = r
            AND abs(d.repeat_purchase_rate - r / nullif(t, 0)) <= 0.000001 THEN 'PASS'
            ELSE 'FAIL' END AS status
    FROM dash_retention_snapshot d JOIN {_SETS} s USING (metric_code)""")
def _(w):
    again = K.retention_recomputed(w["gold_customer_delivered_orders"], w["gold_dataset_dates"])
    return K.retention_metrics(w["dash_retention_snapshot"], again).withColumn(
        "rate_diff", F.round("rate_diff", 9))


@query("test_category_metrics", f"""
    SELECT count(*) AS category_months_checked, max(abs(m.category_gmv - r.gmv))::DOUBLE
            AS max_category_gmv_diff,
        max(abs(m.category_order_count - r.n))::BIGINT AS max_category_order_count_diff,
        CASE WHEN max(abs(m.category_gmv - r.gmv)) <= 0.01
            AND max(abs(m.category_order_count - r.n)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM dash_category_monthly m JOIN (SELECT report_month, category, sum(gmv) AS gmv, count(*) AS n
        FROM (SELECT {_MONTH}, product_category_name_english AS category, order_id,
                sum(price + coalesce(freight_value, 0)) AS gmv
              FROM raw_order_items JOIN raw_orders USING (order_id)
              LEFT JOIN silver_products USING (product_id)
              WHERE order_status = 'delivered' GROUP BY ALL) x GROUP BY ALL) r
        ON m.report_month = r.report_month AND m.category IS NOT DISTINCT FROM r.category""")
def _(w):
    found = K.category_metrics(w["dash_category_monthly"], w["gold_fact_order_items"])
    return found.withColumn("max_category_gmv_diff", F.col("max_category_gmv_diff").cast("double"))


_LOGIC = """
    SELECT check_name, issue_count,
        CASE WHEN (issue_count = 0) <> wants_some THEN 'PASS' ELSE 'FAIL' END AS status,
        rationale
    FROM (
        SELECT 'delivered-only sales facts' AS check_name,
            'no order counts as delivered on one line and not on another' AS rationale,
            FALSE AS wants_some,
            (SELECT coalesce(sum(n_not), 0)::BIGINT FROM (
                SELECT count(*) FILTER (NOT is_delivered) AS n_not FROM gold_fact_order_items
                GROUP BY order_id HAVING bool_or(is_delivered)) x) AS issue_count
        UNION ALL SELECT 'retention uses customer_unique_id, not customer_id',
            'customer_id belongs to one order, so it cannot show repeat purchases', FALSE,
            (SELECT count(*) FROM (SELECT 1 FROM gold_customer_delivered_orders
                GROUP BY customer_id HAVING count(DISTINCT order_id) > 1) x)
        UNION ALL SELECT 'customer_unique_id has repeat buyers',
            'counted by person, some customers order again', TRUE,
            (SELECT count(*) FROM (SELECT 1 FROM gold_customer_delivered_orders
                GROUP BY customer_unique_id HAVING count(DISTINCT order_id) > 1) x)
        UNION ALL SELECT 'installment numerator uses payment_installments > 1',
            'an installment order needs a payment with more than one installment', FALSE,
            (SELECT count(*) FROM gold_fact_orders o WHERE is_delivered AND uses_installments
                AND order_id NOT IN (SELECT order_id FROM raw_order_payments
                                     WHERE payment_installments > 1))
        UNION ALL SELECT 'payment_installments = 0 not counted as installment',
            '0 installments is a data quirk, not installment use', FALSE,
            (SELECT count(*) FROM gold_fact_order_payments
                WHERE payment_installments = 0 AND is_installment_payment)
        UNION ALL
        SELECT 'delivery delay denominator excludes inconsistent delivery records',
            'the delay rate needs delivered orders with usable dates', FALSE,
            (SELECT count(*) FROM gold_fact_orders
                WHERE is_valid_for_delivery_delay_kpi AND is_delivery_inconsistency)
        UNION ALL SELECT 'review fact is delivered orders only',
            'the review score covers delivered orders', FALSE,
            (SELECT count(*) FROM gold_fact_order_reviews r JOIN silver_orders o
                ON r.order_id = o.order_id WHERE o.order_status <> 'delivered')
        UNION ALL SELECT 'reviews do not inflate gold_fact_orders grain',
            'reviews are aggregated to the order before they are joined', FALSE,
            (SELECT count(*) - count(DISTINCT order_id) FROM gold_fact_orders)
    ) r"""


@query("test_business_logic", _LOGIC)
def _(w):
    return K.business_logic(w)


@query("test_window_logic", """
    SELECT a.metric_code || ' >= ' || b.metric_code || ' usually expected' AS check_name,
        a.returning_customers AS left_value, b.returning_customers AS right_value,
        CASE WHEN a.returning_customers >= b.returning_customers THEN 'PASS' ELSE 'REVIEW' END
            AS status,
        'bought in the last ' || a.metric_code[6:6] || ' months and earlier, against more than '
            || 'one order inside them' AS rationale
    FROM dash_retention_snapshot a JOIN dash_retention_snapshot b
        ON b.metric_code = replace(a.metric_code, 'returning_customer', 'repeat_purchase')
    WHERE a.metric_code LIKE '%returning_customer'""")
def _(w):
    return K.window_logic(w["dash_retention_snapshot"])
