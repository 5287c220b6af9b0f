"""Exploratory summaries."""

from __future__ import annotations

from tradewind.operators import explore as X
from tradewind.queries import query
from tradewind.queries.quality import UNION

_COLS = {"gold_fact_orders": 25, "gold_fact_order_items": 20, "gold_fact_order_payments": 12,
         "gold_fact_order_reviews": 11, "gold_customer_delivered_orders": 5,
         "dash_kpi_monthly": 13, "dash_retention_snapshot": 6}


@query("eda_table_shapes", UNION.join(
    f"SELECT '{t}' AS table_name, {n}::INT AS cols, count(*) AS rows FROM {t}"
    for t, n in _COLS.items()))
def _(w):
    return X.table_shapes(w)


@query("eda_describe_orders", UNION.join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, count(DISTINCT {c}) AS unique,
        mode() WITHIN GROUP (ORDER BY {c}::VARCHAR) AS top,
        (SELECT max(n) FROM (SELECT count({c}) AS n FROM gold_fact_orders GROUP BY {c}) g)
            AS freq, NULL::TIMESTAMP AS mean, NULL::TIMESTAMP AS min, NULL::TIMESTAMP AS p25,
        NULL::TIMESTAMP AS p50, NULL::TIMESTAMP AS p75, NULL::TIMESTAMP AS max
    FROM gold_fact_orders""" for c in ("order_status", "is_delivered")) + """
    UNION ALL SELECT 'order_purchase_timestamp', count(us), NULL, NULL, NULL,
        make_timestamp((sum(us) // count(us))::BIGINT), make_timestamp(min(us)),
        make_timestamp(floor(quantile_cont(us::DOUBLE, 0.25))::BIGINT),
        make_timestamp(floor(quantile_cont(us::DOUBLE, 0.5))::BIGINT),
        make_timestamp(floor(quantile_cont(us::DOUBLE, 0.75))::BIGINT), make_timestamp(max(us))
    FROM (SELECT epoch_us(order_purchase_timestamp) AS us FROM gold_fact_orders) t""")
def _(w):
    return X.describe_orders(w["gold_fact_orders"])


@query("eda_status_distribution", """
    SELECT order_status, count(*) AS orders,
        count(*) / (SELECT count(*) FROM gold_fact_orders) AS pct
    FROM gold_fact_orders GROUP BY order_status""")
def _(w):
    return X.value_counts(w.order_facts(), "order_status")


@query("eda_purchase_range", """
    SELECT min(order_purchase_timestamp) AS min_purchase_ts,
        max(order_purchase_timestamp) AS max_purchase_ts FROM gold_fact_orders""")
def _(w):
    return X.purchase_range(w.order_facts())


@query("eda_critical_null_rates", UNION.join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) / count(*) AS null_rate "
    "FROM gold_fact_orders" for c in X.CRITICAL))
def _(w):
    return X.null_rates(w.order_facts(), X.CRITICAL)


_PER = """(SELECT customer_unique_id, count(DISTINCT order_id) AS n
    FROM gold_customer_delivered_orders GROUP BY 1) c"""


@query("eda_customer_frequency", UNION.join(
    f"SELECT '{m}' AS metric, count(*) FILTER ({p}) AS value, "
    f"count(*) FILTER ({p}) / count(*) AS rate FROM {_PER}" for m, p in [("one_time_customers", "n = 1"),
                                ("repeat_customers_gt1", "n > 1"),
                                ("loyal_customers_ge5", "n >= 5")]))
def _(w):
    return X.customer_frequency(w["gold_customer_delivered_orders"])


@query("eda_order_count_distribution",
       f"SELECT n AS delivered_orders, count(*) AS customers FROM {_PER} GROUP BY 1")
def _(w):
    return X.order_count_distribution(w["gold_customer_delivered_orders"])


_GMV = """(SELECT customer_unique_id, sum(order_gmv) AS customer_gmv FROM gold_fact_orders
    WHERE is_delivered AND customer_unique_id IS NOT NULL GROUP BY 1) c"""
_RUN = f"""(SELECT *, sum(customer_gmv) OVER up AS running, row_number() OVER up AS place,
        sum(customer_gmv) OVER () AS total, count(*) OVER () AS n FROM {_GMV}
    WINDOW up AS (ORDER BY customer_gmv DESC, customer_unique_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r"""


@query("eda_pareto_customers", f"""
    SELECT customer_unique_id, customer_gmv, running::DOUBLE / total::DOUBLE AS cum_gmv_pct,
        place / n AS cum_customer_pct FROM {_RUN}""", "customer_gmv")
def _(w):
    return X.pareto_customers(w["gold_fact_orders"])


@query("eda_top20_share", f"""
    SELECT coalesce(sum(customer_gmv) FILTER (place / n <= 0.2), 0)::DOUBLE
        / sum(customer_gmv)::DOUBLE AS top20_gmv_share FROM {_RUN}""")
def _(w):
    return X.top_share(w["gold_fact_orders"])


@query("eda_order_gmv_quantiles", """
    SELECT quantile_cont(order_gmv::DOUBLE, 0.95) AS gmv_p95,
        quantile_cont(order_gmv::DOUBLE, 0.99) AS gmv_p99, max(order_gmv) AS gmv_max
    FROM gold_fact_orders WHERE is_delivered""", "gmv_max")
def _(w):
    return X.order_gmv_quantiles(w.order_facts())


@query("eda_gmv_histogram", """
    SELECT b::INT AS bin, lo / 100 + (hi - lo) / 100 / 50 * b AS bin_left,
        lo / 100 + (hi - lo) / 100 / 50 * (b + 1) AS bin_right,
        (SELECT count(*) FROM kept WHERE least((c - lo) * 50 // (hi - lo), 49) = b) AS orders
    FROM (SELECT unnest(range(50)) AS b) s,
        (SELECT min(c) AS lo, max(c) AS hi FROM kept) e""".replace("kept", """(
        SELECT (order_gmv * 100)::BIGINT AS c FROM gold_fact_orders
        WHERE is_delivered AND order_gmv::DOUBLE <= (
            SELECT quantile_cont(order_gmv::DOUBLE, 0.95) FROM gold_fact_orders
            WHERE is_delivered)) k"""))
def _(w):
    return X.gmv_histogram(w.order_facts())


@query("eda_category_rollup", """
    SELECT category, sum(category_gmv) AS total_gmv,
        sum(category_order_count)::BIGINT AS total_orders,
        sum(category_gmv)::DOUBLE / sum(category_order_count) AS category_aov,
        sum(category_gmv)::DOUBLE / 1000000 AS total_gmv_million
    FROM dash_category_monthly WHERE category IS NOT NULL GROUP BY category""", "total_gmv")
def _(w):
    return X.category_rollup(w["dash_category_monthly"])


@query("eda_unknown_share", """
    SELECT coalesce(sum(category_gmv) FILTER (category = 'Unknown'), 0)::DOUBLE
        / sum(category_gmv)::DOUBLE AS unknown_gmv_share
    FROM dash_category_monthly WHERE category IS NOT NULL""")
def _(w):
    return X.unknown_share(w["dash_category_monthly"])


@query("eda_retention_trend", """
    SELECT report_month, list_position(['lifetime_repeat_purchase',
            'last_3m_returning_customer', 'last_6m_returning_customer',
            'last_3m_repeat_purchase', 'last_6m_repeat_purchase'], metric_code)::INT
            AS metric_order, metric_code, repeat_purchase_rate
    FROM dash_retention_monthly""")
def _(w):
    return X.retention_trend(w["dash_retention_monthly"])


@query("eda_kpi_trends", """
    SELECT report_month, total_orders, gmv, actual_payment, aov, delivery_delay_rate,
        installment_usage_rate FROM dash_kpi_monthly""", "gmv actual_payment")
def _(w):
    return X.kpi_trends(w["dash_kpi_monthly"])
