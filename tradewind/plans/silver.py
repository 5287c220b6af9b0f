"""Cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def geolocation(raw_geolocation: DataFrame) -> DataFrame:
    return raw_geolocation.dropna(how="any").distinct()


def products(raw_products: DataFrame, raw_category_translation: DataFrame) -> DataFrame:
    """Products with the English category, 'Unknown' where there is none.

    The flag marks a category that exists but has no translation.
    """
    p, t = raw_products.alias("p"), raw_category_translation.alias("t")
    has_translation = F.col("t.product_category_name").isNotNull()
    kept = [f"p.{c}" for c in raw_products.columns[2:]]
    return p.join(t, F.col("p.product_category_name") == F.col("t.product_category_name"),
                  "left").select(
        "p.product_id",
        "p.product_category_name",
        F.coalesce("t.product_category_name_english", F.lit("Unknown"))
        .alias("product_category_name_english"),
        *kept,
        (F.col("p.product_category_name").isNotNull() & ~has_translation)
        .alias("missing_translation_flag"),
    )


def orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with a flag for delivered ones that lack a delivery time."""
    return raw_orders.withColumn(
        "is_delivery_inconsistency",
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull(),
    )
