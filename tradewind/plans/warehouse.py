"""The table graph: raw -> silver -> gold -> dash, lazily or written per layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind import schema
from tradewind.plans import gold, marts, retention, silver
from tradewind.sources import readers, standins
from tradewind.sources.snapshots import Snapshots

# Derived tables in build order. Each entry maps the warehouse to a DataFrame.
TABLES: dict[str, Callable[["Warehouse"], DataFrame]] = {
    "silver_geolocation": lambda w: silver.geolocation(w["raw_geolocation"]),
    "silver_products": lambda w: silver.products(
        w["raw_products"], w["raw_category_translation"]),
    "silver_orders": lambda w: silver.orders(w["raw_orders"]),
    "gold_dataset_dates": lambda w: gold.dataset_dates(w["silver_orders"]),
    "gold_dim_date": lambda w: gold.dim_date(w["silver_orders"]),
    "gold_dim_customer": lambda w: gold.dim_customer(
        w["raw_customers"], w["silver_geolocation"]),
    "gold_dim_unique_customer": lambda w: gold.dim_unique_customer(
        w["gold_dim_customer"], w["silver_orders"]),
    "gold_dim_product": lambda w: gold.dim_product(w["silver_products"]),
    "gold_fact_orders": lambda w: gold.fact_orders(w.order_facts(), w["raw_customers"]),
    "gold_fact_order_items": lambda w: gold.fact_order_items(
        w["raw_order_items"], w["silver_orders"], w["silver_products"]),
    "gold_fact_order_payments": lambda w: gold.fact_order_payments(
        w["raw_order_payments"], w["silver_orders"]),
    "gold_fact_order_reviews": lambda w: gold.fact_order_reviews(
        w["raw_order_reviews"], w["silver_orders"]),
    "gold_customer_delivered_orders": lambda w: gold.customer_delivered_orders(
        w["silver_orders"], w["raw_customers"]),
    "gold_customer_rfm": lambda w: gold.customer_rfm(
        gold.customer_metrics(w["gold_fact_orders"], w["gold_dataset_dates"])),
    "dash_kpi_monthly": lambda w: marts.kpi_monthly(
        w.order_facts(), w["gold_fact_order_reviews"]),
    "dash_kpi_daily": lambda w: marts.kpi_daily(w.order_facts()),
    "dash_kpi_weekly": lambda w: marts.kpi_weekly(w.order_facts()),
    "dash_category_monthly": lambda w: marts.category_monthly(w["gold_fact_order_items"]),
    "dash_retention_snapshot": lambda w: retention.snapshot(
        w["gold_customer_delivered_orders"], w["gold_dataset_dates"]),
    "dash_retention_monthly": lambda w: retention.monthly(
        w["gold_customer_delivered_orders"]),
}

# Large facts are stored by purchase month, the column most filters use.
PARTITIONED = {
    "gold_fact_orders": "order_purchase_month",
    "gold_fact_order_items": "order_purchase_month",
    "gold_fact_order_payments": "order_purchase_month",
    "gold_fact_order_reviews": "order_purchase_month",
}


# Sorted inside their files by the key of most lookups.
SORTED = {name: "order_id" for name in [*PARTITIONED, "gold_fact_orders", "silver_orders"]}


class Warehouse:
    """Tables by name. Derived ones are built on first use, most of them
    lazily (global ranks store a split), and read back once `materialise` has written them."""

    def __init__(self, spark: SparkSession, open_raw: Callable[[str], DataFrame]):
        self.spark = spark
        self._open_raw = open_raw  # called once per raw table, on first use
        self._tables: dict[str, DataFrame] = {}
        self._order_facts: DataFrame | None = None
        self._stored: set[str] = set()

    @classmethod
    def from_csv(cls, spark: SparkSession, paths: dict[str, str]) -> "Warehouse":
        return cls(spark, lambda t: readers.raw_csv(spark, t, paths[t]))

    @classmethod
    def from_testdata(cls, spark: SparkSession, folder: str) -> "Warehouse":
        return cls(spark, lambda t: standins.load(spark, folder, t))

    @classmethod
    def from_store(cls, spark: SparkSession, folder: str) -> "Warehouse":
        """Raw tables stored as parquet, one folder per table."""
        return cls(spark, lambda t: readers.table_scan(spark, f"{folder}/{t}"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = (
                self._open_raw(name) if name in schema.RAW else TABLES[name](self))
        return self._tables[name]

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {t: self[t] for t in schema.RAW}

    def order_facts(self) -> DataFrame:
        """The order fact, without the person id unless it is stored already."""
        if "gold_fact_orders" in self._stored:
            return self["gold_fact_orders"]
        if self._order_facts is None:
            self._order_facts = gold.order_facts(
                self["silver_orders"], self["raw_order_items"], self["raw_order_payments"],
                self["raw_order_reviews"])
        return self._order_facts

    def materialise(self, folder: str, *names: str) -> "Warehouse":
        """Write tables (all by default) in build order; later ones read the
        written ones, so a layer is computed once and lineage stays short. All of them
        replace what the folder held at the same moment; a failure leaves it as it was."""
        store = Snapshots(self.spark, folder)
        before = dict(self._tables), set(self._stored)
        try:
            with store.writer() as out:
                for name in names or TABLES:
                    self._tables[name] = out.add(
                        name, self[name], PARTITIONED.get(name), SORTED.get(name))
                    self._stored.add(name)
        except BaseException:
            self._tables, self._stored = before
            raise
        store.vacuum()
        return self
