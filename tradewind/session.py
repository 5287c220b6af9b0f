"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on (time zone, ANSI) and the ones that keep
# plans healthy when one key holds a large share of the rows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def create(app: str = "tradewind", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply(spark: SparkSession) -> None:
    """Give the session the settings that results and plans depend on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or else the one given
    to setCheckpointDir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return os.path.dirname(current)
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def use_local_folder(spark: SparkSession) -> None:
    """For tests and trial runs in one process: a folder of their own, if none is set."""
    context = spark.sparkContext
    if (not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir()
            and re.fullmatch(r"local(\[.*\])?", context.master)):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tradewind-"))


_written: dict[str, list[str]] = {}
_cleared: dict[str, int] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for one written table. `clear` deletes it."""
    path = f"{checkpoint_root(spark).rstrip('/')}/tradewind/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application has written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def clear(spark: SparkSession) -> int:
    """Delete what this application has written below the shared folder, once no frame that
    reads it is needed any more. Returns the number of paths."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop(spark, path)
    app = spark.sparkContext.applicationId
    _cleared[app] = _cleared.get(app, 0) + 1
    return len(paths)


def generation(spark: SparkSession) -> tuple[str, int]:
    """Changes whenever `clear` has deleted scratch tables: what is kept between calls and
    reads such tables is to be kept under this key."""
    app = spark.sparkContext.applicationId
    return app, _cleared.get(app, 0)


def settled(df, name: str = "settled"):
    """Write `df` once below the shared folder and return a scan of it.

    For a frame that several passes read: it cuts the lineage, survives lost
    executors and keeps column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
