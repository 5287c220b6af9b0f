"""Small helpers that the operators share: reading, scratch tables, blocks of rows.

Shared conventions, tested in tests/llm: a null text counts as empty, ids may be
null or repeated, and operators pick the columns they need before they add their
own, so other columns of any name never clash with theirs.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import session

BLOCK_CHARS = 4_000_000
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application, and have
    Arrow batches of `BATCH_ROWS` documents, unless the session has a size of its own."""
    session.use_local_folder(spark)  # where no shared folder is set, as in tests
    if spark.conf.get(BATCH_SETTING) == "10000":  # the default
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip",
                                      package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text), the id as long, a null text as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the cluster's shared folder and return a scan of it: the
    lineage ends there and a lost executor costs no recomputation."""
    return session.settled(df, name)


def blocks(batches: Iterator[pd.DataFrame], column: str = "text",
           chars: int = BLOCK_CHARS) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches by the size of their texts, so that memory follows the block
    and not the row count. One row is never cut."""
    for batch in batches:
        if not len(batch):
            continue
        ends = batch[column].str.len().to_numpy().cumsum()
        start = 0
        while start < len(batch):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(base + chars, side="right")))
            yield batch.iloc[start:stop]
            start = stop


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that is no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
