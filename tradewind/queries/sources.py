"""Readers and sinks: tables are written below the session's shared folder and
read back with their declared schemas."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schema
from tradewind.operators.quality import ORDER_STATUSES, union
from tradewind.queries import query
from tradewind.session import scratch_path, settled
from tradewind.sources import readers, sinks


# What a column holds, in one exact number: sums, seconds, or the hashed text.
def _measure(kind: T.DataType, c: str, spark: bool) -> str:
    if isinstance(kind, T.StringType):
        head = f"substr(md5(CAST({c} AS {'STRING' if spark else 'VARCHAR'})), 1, 7)"
        return f"CAST(conv({head}, 16, 10) AS BIGINT)" if spark else f"CAST('0x' || {head} AS BIGINT)"
    if isinstance(kind, T.TimestampNTZType):
        return (f"datediff(CAST({c} AS DATE), DATE'1970-01-01')" if spark
                else f"date_diff('day', DATE '1970-01-01', CAST({c} AS DATE))")
    if isinstance(kind, T.DateType):
        return (f"datediff({c}, DATE'1970-01-01')" if spark
                else f"date_diff('day', DATE '1970-01-01', {c})")
    return f"CAST({c} AS DECIMAL(28,4))"


def _contents(table: str, df, columns: T.StructType):
    """(table_name, column_name, rows, filled, total) of a table, one row a column."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[x for i, f in enumerate(columns) for x in (
        F.count(f.name).alias(f"f{i}"),
        F.sum(F.expr(_measure(f.dataType, f.name, True))).cast("double").alias(f"t{i}"))])
    return wide.select(F.explode(F.array(*[F.struct(
        F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"), F.col("n").alias("rows"),
        F.col(f"f{i}").alias("filled"), F.col(f"t{i}").alias("total"))
        for i, f in enumerate(columns)])).alias("r")).select("r.*")


def _contents_sql(table: str, columns: T.StructType) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, count(*) AS rows, "
        f"count({f.name}) AS filled, "
        f"sum({_measure(f.dataType, f.name, False)})::DOUBLE AS total FROM {table}" for f in columns)


@query("src_csv_typed", " UNION ALL ".join(_contents_sql(t, c) for t, c in schema.RAW.items()))
def _(w):
    """All nine raw files, written as CSV and read with their declared types."""
    out = []
    for table, columns in schema.RAW.items():
        path = sinks.csv_export(w[table], scratch_path(w.spark, f"{table}-csv"))
        out.append(_contents(table, readers.raw_csv(w.spark, table, path), columns))
    return union(out)


_HORIZON = "(SELECT max(order_date) AS d FROM ml_daily_business_metrics)"


@query("src_csv_ml_outputs", f"""
    SELECT 'ml_daily_business_metrics' AS table_name, count(*) AS rows,
        sum(orders)::DOUBLE AS total FROM ml_daily_business_metrics
    UNION ALL SELECT 'ml_forecast_result_daily', 30, 465
    UNION ALL SELECT 'ml_forecast_result_monthly', count(DISTINCT date_trunc('month', x)), 30
        FROM (SELECT d + unnest(range(1, 31))::INT AS x FROM {_HORIZON} h) m
    UNION ALL SELECT 'ml_rf_model_performance', 6, 6 * 5
    UNION ALL SELECT 'ml_rf_feature_importance', 20, 210""")
def _(w):
    """All five forecast files, written as CSV and read with their declared types. `total` adds
    up orders, steps, days, folds and ranks."""
    from tradewind.queries.forecast import forecast_of

    added = {"ml_daily_business_metrics": "orders", "ml_forecast_result_daily": "forecast_step",
             "ml_forecast_result_monthly": "forecast_days", "ml_rf_model_performance": "cv_splits",
             "ml_rf_feature_importance": "rank"}
    out = []
    for table, df in forecast_of(w).tables().items():
        path = sinks.csv_export(df, scratch_path(w.spark, f"{table}-csv"))
        out.append(readers.ml_csv(w.spark, table, path).dropna("any").agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.sum(added[table]).cast("double").alias("total")))
    return union(out)


@query("src_table_scan", """
    SELECT order_id, order_purchase_date, order_gmv FROM gold_fact_orders
    WHERE is_delivered ORDER BY order_purchase_date, order_id""", "order_gmv")
def _(w):
    path = scratch_path(w.spark, "fact-orders")
    sinks.overwrite(w["gold_fact_orders"], path, "order_purchase_month")
    return (
        readers.table_scan(
            w.spark, path, "order_id", "order_purchase_date", "order_gmv", "is_delivered")
        .filter("is_delivered").drop("is_delivered")
        .orderBy("order_purchase_date", "order_id"))


@query("src_values", "SELECT e.order_status, count(order_id) AS orders FROM (VALUES "
       + ", ".join(f"('{s}')" for s in ORDER_STATUSES)
       + ") AS e(order_status) LEFT JOIN raw_orders o ON o.order_status = e.order_status "
       "GROUP BY 1")
def _(w):
    wanted = readers.values(w.spark, "order_status string", [(s,) for s in ORDER_STATUSES])
    found = w["raw_orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    return wanted.join(found, "order_status", "left").fillna(0, ["orders"])


@query("src_date_spine", """
    SELECT order_status, unnest(generate_series(min(order_purchase_timestamp)::DATE,
        max(order_purchase_timestamp)::DATE, INTERVAL 1 DAY))::DATE AS day
    FROM raw_orders GROUP BY order_status""")
def _(w):
    day = F.col("order_purchase_timestamp").cast("date")
    bounds = w["raw_orders"].groupBy("order_status").agg(
        F.min(day).alias("lo"), F.max(day).alias("hi"))
    return readers.day_spine(bounds, "lo", "hi", "day", "order_status")


@query("src_json_landing", """
    SELECT order_id::VARCHAR AS order_id, payment_sequential, payment_type,
        payment_installments, payment_value FROM raw_order_payments""", "payment_value")
def _(w):
    path = scratch_path(w.spark, "payments-json")
    payments = w["raw_order_payments"]
    payments.withColumn("order_id", F.col("order_id").cast("string")).write.json(path)
    return readers.json_landing(w.spark, path, schema.RAW["raw_order_payments"])


@query("sink_table_overwrite", "SELECT * FROM silver_orders")
def _(w):
    path = scratch_path(w.spark, "silver-orders")
    sinks.overwrite(w["raw_orders"], path)  # replaced by the next write
    return sinks.overwrite(w["silver_orders"], path)


@query("sink_temp_result", """
    SELECT 'by status' AS question, count(*) AS answer FROM
        (SELECT DISTINCT order_status FROM silver_orders) s
    UNION ALL SELECT 'inconsistent', count(*) FILTER (is_delivery_inconsistency)
    FROM silver_orders""")
def _(w):
    n = F.count(F.lit(1)).alias("answer")
    with sinks.temp_result(w["silver_orders"]) as kept:
        return settled(union([
            kept.select("order_status").distinct().agg(n)
            .select(F.lit("by status").alias("question"), "answer"),
            kept.agg(F.count_if("is_delivery_inconsistency").alias("answer"))
            .select(F.lit("inconsistent").alias("question"), "answer"),
        ]), "answers")


@query("sink_csv_export", "SELECT * FROM dash_kpi_daily", "gmv actual_payment")
def _(w):
    path = sinks.csv_export(w["dash_kpi_daily"], scratch_path(w.spark, "kpi-daily-csv"))
    return readers.csv_typed(w.spark, path, T.StructType([
        T.StructField(f.name, f.dataType) for f in w["dash_kpi_daily"].schema.fields]))


_KEY = ["order_id", "order_item_id"]


@query("sink_constraint_check", """
    SELECT c || ' NOT NULL' AS constraint_name, n AS violations FROM (
        SELECT unnest(['order_id', 'price', 'freight_value']) AS c,
            unnest([count(*) FILTER (order_id IS NULL), count(*) FILTER (price IS NULL),
                    count(*) FILTER (freight_value IS NULL)]) AS n FROM raw_order_items) x
    UNION ALL SELECT 'PRIMARY KEY (order_id, order_item_id)',
        count(*) - count(DISTINCT (order_id, order_item_id)) FROM raw_order_items""")
def _(w):
    return sinks.constraint_violations(
        w["raw_order_items"], ["order_id", "price", "freight_value"], _KEY)
