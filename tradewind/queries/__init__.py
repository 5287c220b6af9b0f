"""Registered queries: name -> Spark job over one folder of given tables, with
the SQL another engine can run for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import session
from tradewind.plans.warehouse import Warehouse
from tradewind.queries import views

JOBS: dict[str, Callable[[Warehouse], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, money: str = ""):
    """Register a job. `money` names the decimal columns, which both engines
    report as double."""

    def keep(job):
        if name in JOBS:
            raise KeyError(f"query {name} is registered twice")
        JOBS[name] = job
        if sql is not None:
            SQL[name] = views.compose(sql, money.split())
        return job

    return keep


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """The job's result. The session gets `session.SETTINGS`, which the lazy result needs
    until it has run; so they stay."""
    session.apply(spark)
    df = JOBS[name](Warehouse.from_testdata(spark, folder))
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def load_all() -> None:
    from tradewind.queries import (  # noqa: F401
        checks, datasets, explore, forecast, quality, relational, report, sources,
    )
