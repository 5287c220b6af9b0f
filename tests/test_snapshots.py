"""Versions of stored tables: what a reader sees when a write fails, dies or meets another."""

import os
import signal
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from tradewind.sources import readers, sinks
from tradewind.sources.snapshots import Conflict, Snapshots

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def numbers(spark, n, start=0):
    return spark.range(start, start + n).withColumn("v", F.col("id") * 2)


def total(df):
    return df.count(), df.agg(F.sum("id")).first()[0]


def test_a_query_may_replace_the_table_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    first = sinks.overwrite(numbers(spark, 100), path)
    for _ in range(3):
        table = readers.table_scan(spark, path)
        made = sinks.overwrite(table.withColumn("id", F.col("id") + 1), path)
        assert total(readers.table_scan(spark, path)) == total(made)
    assert total(made) == (100, 4950 + 300)
    with pytest.raises(Exception):
        first.collect()  # three versions ago: vacuumed
    assert len(Snapshots(spark, path).versions()) == 2


def test_a_failed_write_leaves_all_tables(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    store.write({"a": numbers(spark, 10), "b": numbers(spark, 20)})
    broken = numbers(spark, 5).withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        store.write({"a": numbers(spark, 1), "b": broken})
    assert store.versions() == [1]
    assert total(store.read("a")) == (10, 45) and total(store.read("b")) == (20, 190)
    assert [p for p in os.listdir(tmp_path) if p.startswith("v-")] == [
        store.manifest()["a"]["path"].split("/")[0]]


def test_tables_change_together_and_others_stay(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    store.write({"a": numbers(spark, 10), "b": numbers(spark, 20)})
    with store.writer() as out:
        out.add("b", numbers(spark, 3))
        assert total(store.read("b")) == (20, 190)  # not yet
        out.add("c", out.scans["b"].filter("id > 0"))
    assert {n: store.read(n).count() for n in store.manifest()} == {"a": 10, "b": 3, "c": 2}
    assert store.read("b", 1).count() == 20
    assert readers.table_scan(spark, f"{tmp_path}/c").count() == 2


def test_two_writers(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    store.write({"a": numbers(spark, 1), "b": numbers(spark, 1)})
    one, two, three = store.writer(), store.writer(), store.writer()
    one.add("a", numbers(spark, 2))
    two.add("b", numbers(spark, 3))
    three.add("a", numbers(spark, 4))
    assert (one.commit(), two.commit()) == (2, 3)  # different tables: both hold
    with pytest.raises(Conflict, match="a"):
        three.commit()
    assert (store.read("a").count(), store.read("b").count()) == (2, 3)


def test_a_taken_number_is_never_overwritten(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    store.write({"a": numbers(spark, 1)})
    waiting = tmp_path / "_manifests" / "x"
    waiting.write_text("{}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    assert not store._renamed(path(str(waiting)), path(store._manifest(1)))
    assert store.read("a").count() == 1


def test_vacuum_keeps_what_is_named(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    for i in range(1, 5):
        store.write({"a": numbers(spark, i)} | ({"b": numbers(spark, 7)} if i == 1 else {}))
    dead = store.writer()
    dead.add("a", numbers(spark, 9))  # never committed
    assert len(store.vacuum(keep=2)) == 1  # the first version still holds b
    assert store.versions() == [3, 4] and store.read("b").count() == 7
    assert store.vacuum(keep=1, orphans=True) and store.read("a").count() == 4
    assert len([p for p in os.listdir(tmp_path) if p.startswith("v-")]) == 2


def test_a_job_killed_in_mid_write_leaves_the_old_version(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "set"))
    store.write({"a": numbers(spark, 10), "b": numbers(spark, 20)})
    code = textwrap.dedent(f"""
        import sys, time
        sys.path.insert(0, {HERE!r})
        from tradewind import session
        from tradewind.sources.snapshots import Snapshots
        from pyspark.sql import functions as F
        spark = session.create("killed", "local[2]", **{{"spark.ui.enabled": "false"}})
        def slow(batches):
            for batch in batches:
                open({str(tmp_path / "begun")!r}, "w").close()
                time.sleep(60)
                yield batch
        out = Snapshots(spark, {str(tmp_path / "set")!r}).writer()
        out.add("a", spark.range(3).withColumn("v", F.col("id")))
        out.add("b", spark.range(3).mapInPandas(slow, "id long").withColumn("v", F.col("id")))
        out.commit()
    """)
    job = subprocess.Popen([sys.executable, "-c", code], start_new_session=True)
    try:
        for _ in range(600):
            if (tmp_path / "begun").exists():
                break
            time.sleep(0.2)
        assert (tmp_path / "begun").exists() and job.poll() is None
    finally:
        os.killpg(job.pid, signal.SIGKILL)
        job.wait()
    assert len([p for p in os.listdir(tmp_path / "set") if p.startswith("v-")]) == 2  # it had begun
    assert total(store.read("a")) == (10, 45) and total(store.read("b")) == (20, 190)
    assert len(store.vacuum(orphans=True)) == 1
    store.write({"b": numbers(spark, 2)})
    assert (store.read("a").count(), store.read("b").count()) == (10, 2)


def read_rows(df):
    """Rows that the scan of a finished query handed on."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_lookups_read_few_row_groups(spark, tmp_path):
    """Keys are sorted inside files and spread over all of them, as order ids are over months."""
    rows = spark.range(0, 200_000, numPartitions=16).select(
        F.md5((F.col("id") * 2654435761 % 1000003).cast("string")).alias("order_id"), "id")
    plain = str(tmp_path / "plain")
    rows.write.option("parquet.block.size", 64 * 1024).parquet(plain)
    spark.conf.set("parquet.block.size", 64 * 1024)
    try:
        stored = sinks.overwrite(rows, str(tmp_path / "t"), sort_by="order_id")
    finally:
        spark.conf.unset("parquet.block.size")
    wanted = [r[0] for r in rows.filter("id % 40000 = 7").select("order_id").collect()] + ["no such id", "f" * 32]
    for key in wanted:
        there = stored.filter(F.col("order_id") == key)
        read = read_rows(there)
        assert there.count() == (0 if key in wanted[-2:] else 1)
        assert read <= 25_000  # of 200,000
    before = sum(read_rows(spark.read.parquet(plain).filter(F.col("order_id") == k)) for k in wanted)
    after = sum(read_rows(stored.filter(F.col("order_id") == k)) for k in wanted)
    assert after * 20 < before
