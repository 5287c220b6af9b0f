"""Most frequent value per group, smallest on ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_modes(df: DataFrame, keys: list[str], columns: list[str],
                  weight: str | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
    """Per key: `<c>` = mode of c and `<c>_distinct` = its distinct non-NULL values.
    A row counts `weight` times, once by default. `sums` are added up in the same pass; with
    them, a key without any value has its row as well.

    Values are counted per (key, column, value) before they meet in one group,
    so a group's state is one running best per column, however large the group.
    """
    sums = sums or {}
    kinds = {name: df.select(c.alias(name)).schema[name].dataType for name, c in sums.items()}

    def entry(name: str, value: Column, carries: bool) -> Column:
        return F.struct(F.lit(name).alias("_column"), value.cast("string").alias("_value"), *[
            (c if carries else F.lit(None).cast(kinds[n])).alias(n) for n, c in sums.items()])

    entries = [entry(c, F.col(c), False) for c in columns]
    if sums:
        entries.append(entry("", F.lit(""), True))
    counted = (
        df.select(*keys, (F.col(weight) if weight else F.lit(1)).alias("_w"),
                  F.explode(F.array(*entries)).alias("v"))
        .select(*keys, "_w", "v.*")
        .filter("_value IS NOT NULL")
        .groupBy(*keys, "_column", "_value")
        .agg(F.sum("_w").alias("_n"), *[F.sum(n).alias(n) for n in sums])
    )
    best = [F.max(n).alias(n) for n in sums]  # one row of a key carries them
    for c in columns:
        here = F.col("_column") == c
        best.append(F.min(F.when(here, F.struct((-F.col("_n")).alias("n"), F.col("_value"))))
                    ["_value"].alias(c))
        best.append(F.count_if(here).alias(f"{c}_distinct"))
    return counted.groupBy(*keys).agg(*best)
