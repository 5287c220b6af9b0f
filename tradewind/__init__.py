"""tradewind: marketplace analytics expressed as Spark DataFrame jobs."""

from tradewind.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
