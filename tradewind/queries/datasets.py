"""Silver, gold and dashboard tables."""

from __future__ import annotations

from tradewind.plans import gold
from tradewind.queries import query

_COORD = "geolocation_lat geolocation_lng"
_SIZES = "product_weight_g product_length_cm product_height_cm product_width_cm"

# query name -> (warehouse table, decimal columns)
_TABLES = {
    "silver_geolocation_dedup": ("silver_geolocation", _COORD),
    "silver_products_translated": ("silver_products", _SIZES),
    "silver_orders_flagged": ("silver_orders", ""),
    "gold_dataset_dates": ("gold_dataset_dates", ""),
    "gold_dim_date": ("gold_dim_date", ""),
    "gold_dim_customer": ("gold_dim_customer", ""),
    "gold_dim_unique_customer": ("gold_dim_unique_customer", ""),
    "gold_dim_product": ("gold_dim_product", _SIZES + " product_volume_cm3"),
    "gold_fact_orders": ("gold_fact_orders", "order_gmv order_payment_total"),
    "gold_fact_order_items": ("gold_fact_order_items", "price freight_value line_gmv"),
    "gold_fact_order_payments": ("gold_fact_order_payments", "payment_value"),
    "gold_fact_order_reviews": ("gold_fact_order_reviews", ""),
    "gold_customer_delivered_orders": ("gold_customer_delivered_orders", ""),
    "gold_customer_rfm": ("gold_customer_rfm", "monetary_gmv"),
    "dash_kpi_monthly": ("dash_kpi_monthly", "gmv actual_payment"),
    "dash_kpi_daily": ("dash_kpi_daily", "gmv actual_payment"),
    "kpi_weekly": ("dash_kpi_weekly", "gmv actual_payment"),
    "dash_category_monthly": ("dash_category_monthly", "category_gmv"),
    "dash_retention_snapshot": ("dash_retention_snapshot", ""),
    "dash_retention_monthly": ("dash_retention_monthly", ""),
}

for _name, (_table, _money) in _TABLES.items():
    query(_name, f"SELECT * FROM {_table}", _money)(lambda w, table=_table: w[table])


@query("rfm_segment_summary", """
    SELECT customer_segment, count(*) AS customers, sum(monetary_gmv) AS segment_gmv,
        sum(frequency_orders)::BIGINT AS segment_orders
    FROM gold_customer_rfm GROUP BY ALL""", "segment_gmv")
def _(w):
    return gold.rfm_segment_summary(w["gold_customer_rfm"])
