"""Raw-table stand-ins over the TPC-like test tables.

Each raw table is a projection of given tables, written as plain SQL
expressions so that the same text can run on another engine. `SQL` holds the
text; `load` applies it to the parquet files of one folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_PLACE = "JOIN nation ON {key} = n_nationkey JOIN region ON n_regionkey = r_regionkey"

SQL = {
    "raw_orders": """
        SELECT o_orderkey AS order_id,
               o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'canceled' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + INTERVAL '1' DAY END
                   AS order_approved_at,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '2' DAY END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0
                    THEN o_orderdate + (o_orderkey % 40) * INTERVAL '1' DAY END
                   AS order_delivered_customer_date,
               o_orderdate + INTERVAL '30' DAY AS order_estimated_delivery_date
        FROM orders""",
    "raw_customers": f"""
        SELECT o_orderkey AS customer_id,
               c_custkey AS customer_unique_id,
               CAST(c_nationkey + 10 AS VARCHAR(10)) AS customer_zip_code_prefix,
               n_name AS customer_city,
               r_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey {_PLACE.format(key="c_nationkey")}""",
    "raw_order_items": """
        SELECT l_orderkey AS order_id,
               l_linenumber AS order_item_id,
               l_partkey AS product_id,
               l_suppkey AS seller_id,
               l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS DECIMAL(18,2)) END
                   AS freight_value
        FROM lineitem""",
    "raw_order_payments": """
        SELECT l_orderkey AS order_id,
               l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                    ELSE 'voucher' END AS payment_type,
               CAST(l_quantity AS INT) % 4 AS payment_installments,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
        FROM lineitem""",
    "raw_order_reviews": """
        SELECT event_id AS review_id,
               CAST(floor(event_id / 2) AS BIGINT) AS order_id,
               CAST(1 + event_id % 5 AS INT) AS review_score,
               CASE WHEN event_type <> 'error' THEN event_type END AS review_comment_title,
               props AS review_comment_message,
               ts AS review_creation_date,
               ts + INTERVAL '1' DAY AS review_answer_timestamp
        FROM events""",
    "raw_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 20 <> 0 THEN lower(p_type) END AS product_category_name,
               CAST(length(p_name) AS INT) AS product_name_lenght,
               CAST(length(p_brand) AS INT) AS product_description_lenght,
               CASE WHEN p_partkey % 20 <> 0 THEN p_size % 5 END AS product_photos_qty,
               CAST(p_size * 100 AS DECIMAL(18,2)) AS product_weight_g,
               CAST(p_size AS DECIMAL(18,2)) AS product_length_cm,
               CAST(p_size + 1 AS DECIMAL(18,2)) AS product_height_cm,
               CASE WHEN p_partkey % 30 <> 0 THEN CAST(p_size + 2 AS DECIMAL(18,2)) END
                   AS product_width_cm
        FROM part""",
    "raw_geolocation": f"""
        SELECT CAST(c_nationkey + 10 AS VARCHAR(10)) AS geolocation_zip_code_prefix,
               CAST(c_custkey % 41 - 35 AS DECIMAL(9,4)) AS geolocation_lat,
               CAST(c_custkey % 47 - 75 AS DECIMAL(9,4)) AS geolocation_lng,
               lower(c_mktsegment) AS geolocation_city,
               r_name AS geolocation_state
        FROM customer {_PLACE.format(key="c_nationkey")}""",
    "raw_sellers": f"""
        SELECT s_suppkey AS seller_id,
               CAST(s_nationkey + 10 AS VARCHAR(10)) AS seller_zip_code_prefix,
               n_name AS seller_city,
               r_name AS seller_state
        FROM supplier {_PLACE.format(key="s_nationkey")}""",
    "raw_category_translation": """
        SELECT * FROM (VALUES
            ('standard', 'standard_goods'), ('small', 'small_goods'), ('large', 'large_goods'),
            ('economy', 'economy_goods'), ('medium', 'medium_goods')
        ) AS t(product_category_name, product_category_name_english)""",
}


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One raw table over the parquet files of a folder.

    The given tables are arguments of the query: no session-wide views are
    registered, so two folders can be open at once.
    """
    text = SQL[table]
    used = [n for n in GIVEN if re.search(rf"\b(FROM|JOIN) {n}\b", text)]
    for name in used:
        text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **{n: given(spark, folder, n) for n in used})
