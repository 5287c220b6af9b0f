"""Table and file sinks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import drop, scratch_path, settled
from tradewind.sources.snapshots import TABLE, Snapshots


def overwrite(df: DataFrame, path: str, partition_by: str | None = None,
              sort_by: str | None = None) -> DataFrame:
    """Rebuild a stored table from a query and return a scan of it.

    The new version appears when all of it is written, so the query may read the table it
    replaces; the version before is kept for readers at work, older ones go. See
    `snapshots` for the options and for several tables at once.
    """
    store = Snapshots(df.sparkSession, path)
    made = store.write({TABLE: df}, {TABLE: partition_by}, {TABLE: sort_by})[TABLE]
    store.vacuum()
    return made


@contextmanager
def temp_result(df: DataFrame) -> Iterator[DataFrame]:
    """A result kept for several queries inside the `with` block, as a scan of a copy in the
    shared folder; the copy goes when the block ends."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "temp")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop(spark, path)


def csv_export(df: DataFrame, path: str) -> str:
    (
        df.write.mode("overwrite")
        .options(header=True, quote='"', escape='"', emptyValue='""',
                 timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
                 timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )
    return path


def constraint_violations(df: DataFrame, not_null: list[str], key: list[str]) -> DataFrame:
    """(constraint, violations): NULLs per column and extra rows per key value.

    One pass: rows and NULLs are counted per key value, then added up.
    """
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)])
    zero = F.lit(0)
    named = [(f"{c} NOT NULL", F.sum(f"_null_{i}")) for i, c in enumerate(not_null)]
    named.append((f"PRIMARY KEY ({', '.join(key)})", F.sum(F.col("_rows") - 1)))
    wide = per_key.agg(*[F.coalesce(c, zero).cast("long").alias(f"_{i}")
                         for i, (_, c) in enumerate(named)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("constraint_name"), F.col(f"_{i}").alias("violations"))
        for i, (name, _) in enumerate(named)])).alias("r")).select("r.*")


def violations(df: DataFrame, not_null: list[str], key: list[str]) -> list[tuple]:
    return [tuple(r) for r in
            constraint_violations(df, not_null, key).filter("violations > 0").collect()]


def checked_overwrite(df: DataFrame, path: str, not_null: list[str], key: list[str]) -> DataFrame:
    """Write the table only if no constraint is violated."""
    df = settled(df, "checked")
    broken = violations(df, not_null, key)
    if broken:
        raise ValueError(f"constraints violated: {broken}")
    return overwrite(df, path)
