"""Typed readers. Text files never have their schema inferred; stored tables bring their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schema
from tradewind.sources import snapshots, splitcsv

# An unquoted empty field is NULL, a quoted one is an empty string. The marker
# must be a value no file holds.
_NULL_MARK = "\u0001"


def csv_typed(
    spark: SparkSession, path: str | list[str], columns: T.StructType, multiline: bool = False
) -> DataFrame:
    """Headered CSV with `"` as quote and escape; a malformed value stops the load.

    Files are split over tasks, also where `multiline` says that records hold line breaks.
    """
    options = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST",
               "nullValue": _NULL_MARK, "enforceSchema": True}
    if multiline:
        return splitcsv.read(spark, path, columns, options)
    return spark.read.schema(columns).options(**options).csv(path)


def raw_csv(spark: SparkSession, table: str, path: str | list[str]) -> DataFrame:
    return csv_typed(spark, path, schema.RAW[table], table in schema.MULTILINE)


def ml_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    return csv_typed(spark, path, schema.ML[table])


def json_landing(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """JSON-lines files landed in a folder."""
    return spark.read.schema(columns).option("mode", "FAILFAST").json(path)


def table_scan(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Columns of a stored table; filters added by the caller reach the files."""
    df = snapshots.scan(spark, path)
    return df.select(*columns) if columns else df


def values(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    """Inline rows as a relation (a literal table in the plan, no Python task)."""
    columns = T.StructType.fromDDL(ddl)
    if not rows:
        return spark.createDataFrame([], columns)

    def literal(value, field):
        return F.lit(value).cast(field.dataType).alias(field.name)

    packed = F.array(*[
        F.struct(*[literal(v, f) for v, f in zip(row, columns.fields)]) for row in rows
    ])
    return spark.range(1).select(F.explode(packed).alias("r")).select("r.*")


def catalog_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column) of every table whose name starts with `raw_`."""
    rows = [
        (name, position, column)
        for name, df in tables.items()
        for position, column in enumerate(df.columns, start=1)
    ]
    listed = values(spark, "table_name string, ordinal_position int, column_name string", rows)
    return listed.filter(F.col("table_name").like("raw\\_%"))


def day_spine(bounds: DataFrame, lo: str, hi: str, name: str, *keys: str) -> DataFrame:
    """One row per day from `lo` to `hi`, inclusive, for each row of `bounds`."""
    days = F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY")))
    return bounds.filter(F.col(lo).isNotNull()).select(*keys, days.alias(name))
