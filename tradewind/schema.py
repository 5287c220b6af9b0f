"""Declared schemas, keys and expected sizes of the raw and forecast tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
COORD = T.DecimalType(38, 20)


def _struct(text: str) -> T.StructType:
    """`name type, name type` with short type names, all columns nullable."""
    short = {
        "str": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
        "money": MONEY, "coord": COORD, "num": T.DecimalType(38, 10),
        "ts": T.TimestampNTZType(), "tstz": T.TimestampType(), "date": T.DateType(),
    }
    fields = []
    for part in text.replace("\n", " ").split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, short[kind]))
    return T.StructType(fields)


# Column names, order and types of the nine raw files. The
# `lenght` spelling is the source's own.
RAW = {
    "raw_customers": _struct(
        "customer_id str, customer_unique_id str, customer_zip_code_prefix str,"
        "customer_city str, customer_state str"
    ),
    "raw_geolocation": _struct(
        "geolocation_zip_code_prefix str, geolocation_lat coord, geolocation_lng coord,"
        "geolocation_city str, geolocation_state str"
    ),
    "raw_order_items": _struct(
        "order_id str, order_item_id int, product_id str, seller_id str,"
        "shipping_limit_date ts, price money, freight_value money"
    ),
    "raw_order_payments": _struct(
        "order_id str, payment_sequential int, payment_type str,"
        "payment_installments int, payment_value money"
    ),
    "raw_order_reviews": _struct(
        "review_id str, order_id str, review_score int, review_comment_title str,"
        "review_comment_message str, review_creation_date ts, review_answer_timestamp ts"
    ),
    "raw_orders": _struct(
        "order_id str, customer_id str, order_status str, order_purchase_timestamp ts,"
        "order_approved_at ts, order_delivered_carrier_date ts,"
        "order_delivered_customer_date ts, order_estimated_delivery_date ts"
    ),
    "raw_products": _struct(
        "product_id str, product_category_name str, product_name_lenght int,"
        "product_description_lenght int, product_photos_qty int, product_weight_g money,"
        "product_length_cm money, product_height_cm money, product_width_cm money"
    ),
    "raw_sellers": _struct(
        "seller_id str, seller_zip_code_prefix str, seller_city str, seller_state str"
    ),
    "raw_category_translation": _struct(
        "product_category_name str, product_category_name_english str"
    ),
}

# Row counts published for the full dataset.
EXPECTED_ROWS = {
    "raw_customers": 99441,
    "raw_geolocation": 1000163,
    "raw_order_items": 112650,
    "raw_order_payments": 103886,
    "raw_order_reviews": 99224,
    "raw_orders": 99441,
    "raw_products": 32951,
    "raw_sellers": 3095,
    "raw_category_translation": 71,
}

# Free text with line breaks: these files cannot be split inside a record.
MULTILINE = {"raw_order_reviews"}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("raw_orders", "customer_id", "raw_customers", "customer_id"),
    ("raw_order_items", "order_id", "raw_orders", "order_id"),
    ("raw_order_items", "product_id", "raw_products", "product_id"),
    ("raw_order_items", "seller_id", "raw_sellers", "seller_id"),
    ("raw_order_payments", "order_id", "raw_orders", "order_id"),
    ("raw_order_reviews", "order_id", "raw_orders", "order_id"),
    ("raw_products", "product_category_name", "raw_category_translation", "product_category_name"),
]

# Forecast outputs: schema, primary key and the columns that may not be NULL
# (all of them).
ML = {
    "ml_daily_business_metrics": _struct(
        "order_date date, orders num, gmv num, unique_customers num"
    ),
    "ml_forecast_result_daily": _struct(
        "forecast_run_id str, generated_at tstz, order_date date, forecast_step int,"
        "forecast_gmv num, forecast_orders num, forecast_daily_unique_customers num, model str"
    ),
    "ml_forecast_result_monthly": _struct(
        "month_start date, forecast_run_id str, generated_at tstz, forecast_gmv num,"
        "forecast_orders num, forecast_daily_unique_customers_sum num,"
        "forecast_days int, model str"
    ),
    "ml_rf_model_performance": _struct(
        "forecast_run_id str, model str, best_params str, test_split str, cv_method str,"
        "cv_splits int, cv_best_daily_rmse num, train_start date, train_end date,"
        "test_start date, test_end date, train_rows int, test_rows int,"
        "monthly_test_rows int, metric_role str, grain str, metric str, value num"
    ),
    "ml_rf_feature_importance": _struct(
        "forecast_run_id str, generated_at tstz, model str, rank int, feature str,"
        "importance num"
    ),
}

ML_KEYS = {
    "ml_daily_business_metrics": ["order_date"],
    "ml_forecast_result_daily": ["forecast_run_id", "order_date"],
    "ml_forecast_result_monthly": ["forecast_run_id", "month_start"],
    "ml_rf_model_performance": ["forecast_run_id", "metric_role", "grain", "metric"],
    "ml_rf_feature_importance": ["forecast_run_id", "feature"],
}

# The five retention metrics in display order.
RETENTION_CODES = [
    "lifetime_repeat_purchase",
    "last_3m_returning_customer",
    "last_6m_returning_customer",
    "last_3m_repeat_purchase",
    "last_6m_repeat_purchase",
]
