"""Shards of nearly equal bytes by sampled splitters.

Rows are ordered by (hash of the text, hash of the id, a stored row number), so equal
texts stand together and any group can be divided. A sample of keys, drawn with a chance
in proportion to size, gives the quantile boundaries of at most `RANGES` ranges; a range
that turns out overfull gets boundaries of its own from a second sample inside it. With
the exact bytes of every range, each row's place in the whole order is known from a sort
within its range, and shard i takes the i-th of equal stretches of bytes. A group of
equal texts that weighs at most `SLACK` of a shard goes whole to where its middle lies,
larger ones are divided between rows. Shards differ from the mean by at most that slack
and one row on either side.

A null text weighs nothing but the constant. Repeated rows and null ids are rows like any
other. No rows give no rows. More shards than rows leave some empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import stored

RANGES, ROWS_A_RANGE, SAMPLES = 4096, 1000, 32
OVERHEAD, SLACK = 16, 0.01
SIGN = 1 << 63


def sizes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row's id, size, checksum and keys, written once so that ties keep their order."""
    text = F.col(text_col).cast("string")
    return stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text.cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), F.col(id_col)).alias("h2"),
        F.monotonically_increasing_id().alias("row")), "sizes")


def key_bytes(*parts: np.ndarray) -> np.ndarray:
    """Keys as bytes that compare like the tuple (h1, h2, row)."""
    both = np.stack(parts, axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(SIGN)
    return np.ascontiguousarray(both.astype(">u8")).view(f"S{8 * len(parts)}").ravel()


def drawn(rows: DataFrame, chance: Column) -> DataFrame:
    """Rows whose hash falls below `chance`: the same rows on every run."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(11), "h1", "h2", "row"), 11) / float(1 << 53)
    return rows.filter(draw < chance)


def boundaries(keys: np.ndarray, parts: int) -> np.ndarray:
    """Quantiles of a sample that was drawn by size."""
    keys = np.sort(keys)
    at = (np.arange(1, parts) * len(keys)) // parts
    return np.unique(keys[at]) if len(keys) else keys


def ranged(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """`rows` with the number of their range. The splitters are bounded by `RANGES`."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    @F.pandas_udf(T.IntegerType())
    def find(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h1, h2, row in parts:
            keys = key_bytes(h1.to_numpy(), h2.to_numpy(), row.to_numpy())
            yield pd.Series(np.searchsorted(shared.value, keys, side="right").astype(np.int32))

    return rows.withColumn("range", find("h1", "h2", "row"))


def totals(rows: DataFrame) -> pd.DataFrame:
    return rows.groupBy("range").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes")).toPandas().sort_values("range")


def split(rows: DataFrame, shards: int) -> DataFrame:
    """`rows` with exact ranges, at most 2 * RANGES of them."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = int(min(RANGES, max(shards, n // ROWS_A_RANGE)))
    sample = drawn(rows, F.col("size") * (parts * SAMPLES / max(total, 1)))
    h1 = sample.select("h1").toPandas()["h1"].to_numpy(np.int64)  # about parts * SAMPLES keys
    least = np.full(len(h1), -SIGN, np.int64)  # equal texts stay on one side
    splitters = boundaries(key_bytes(h1, least, least), parts)
    first = ranged(rows, splitters)
    found = totals(first)
    full = found[found["bytes"] > 2 * total / parts]
    if len(full):
        extra = dict(zip(full["range"].tolist(), np.ceil(
            full["bytes"] * parts / total).astype(int).tolist(), strict=True))
        weights = rows.sparkSession.createDataFrame(
            [(r, float(n * SAMPLES / b)) for (r, n), b in
             zip(extra.items(), full["bytes"].tolist(), strict=True)], "range int, w double")
        inside = drawn(first.join(F.broadcast(weights), "range"), F.col("size") * F.col("w"))
        keys = inside.select("range", "h1", "h2", "row").toPandas()
        splitters = np.unique(np.concatenate([splitters, *[
            boundaries(key_bytes(g["h1"].to_numpy(), g["h2"].to_numpy(), g["row"].to_numpy()), extra[r])
            for r, g in keys.groupby("range")]]))
        first = ranged(rows, splitters)
    return first


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row; slots count from 0 in a shard."""
    rows = split(sizes(docs, id_col, text_col), shards)
    by_range = Window.partitionBy("range").orderBy("h1", "h2", "row")
    running = by_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spark = docs.sparkSession
    found = totals(rows)
    total = int(found["bytes"].sum())
    before = spark.createDataFrame(
        pd.DataFrame({"range": found["range"].astype("int32"),
                      "bytes_before": found["bytes"].cumsum() - found["bytes"]}),
        "range int, bytes_before long")
    group = Window.partitionBy("range", "h1")
    placed = (rows.withColumn("end", F.sum("size").over(running))
              .withColumn("group_end", F.max("end").over(group))
              .withColumn("group_size", F.sum("size").over(group))
              .join(F.broadcast(before), "range"))
    whole = F.col("group_size") <= SLACK * total / shards
    middle = F.col("bytes_before") + F.when(whole, F.col("group_end") - F.col("group_size") / 2).otherwise(
        F.col("end") - F.col("size") / 2)
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / max(total, 1))).cast("int")
    placed = stored(placed.select("doc_id", "size", "text_crc32", "range", "h1", "h2", "row",
                                  shard.alias("shard")), "placed")
    # A stretch of the order that lies in one range and one shard: at most ranges + shards.
    stretch = placed.groupBy("range", "shard").agg(F.count("*").alias("n")).toPandas()
    stretch = stretch.sort_values(["shard", "range"])
    stretch["first"] = stretch.groupby("shard")["n"].cumsum() - stretch["n"]
    starts = spark.createDataFrame(stretch[["range", "shard", "first"]],
                                   "range int, shard int, first long")
    within = Window.partitionBy("range", "shard").orderBy("h1", "h2", "row")
    return (placed.withColumn("i", F.row_number().over(within))
            .join(F.broadcast(starts), ["range", "shard"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first") + F.col("i") - 1).cast("long").alias("slot")))


def report(docs: DataFrame, shards: int) -> DataFrame:
    return assign(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write `docs` with its shard as the folder. Rows meet their shard by id and text, so
    repeated rows share one; a shard is written by as many tasks as its size asks for."""
    shard = (assign(docs, shards, id_col, text_col)
             .groupBy("doc_id", "text_crc32").agg(F.min("shard").alias("shard")))
    text = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.crc32(text).alias("crc"))
    (rows.join(shard, rows["id"].eqNullSafe(shard["doc_id"]) & (rows["crc"] == shard["text_crc32"]))
     .select("row.*", "shard").hint("rebalance", "shard")
     .write.partitionBy("shard").parquet(path))
