"""Split reading of CSV with quoted line breaks against the single-task reader."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from tradewind.sources import readers, splitcsv

KIND = T.StructType().add("a", "string").add("b", "integer").add("c", "string")
SPLIT = "spark.sql.files.maxPartitionBytes"


def field(rng):
    parts = ["x", '"', "\n", ",", "é", "word", '""', " ", "\r\n", "\n\n"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))


def content(rng, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL)
    writer.writerow(["a", "b", "c"])
    for i in range(rows):
        writer.writerow([field(rng), i, field(rng)])
    return out.getvalue()


def single(spark, path):
    """Spark's own reader, one task a file."""
    return spark.read.schema(KIND).options(
        header=True, quote='"', escape='"', mode="FAILFAST", multiLine=True,
        nullValue=readers._NULL_MARK, enforceSchema=True).csv(path)


@pytest.fixture
def narrow(spark):
    keep = spark.conf.get(SPLIT), spark.conf.get("spark.sql.files.openCostInBytes")

    def set_to(size):
        spark.conf.set(SPLIT, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield set_to
    spark.conf.set(SPLIT, keep[0])
    spark.conf.set("spark.sql.files.openCostInBytes", keep[1])


def same(spark, path):
    want = sorted(map(tuple, single(spark, path).collect()), key=repr)
    assert sorted(map(tuple, readers.csv_typed(spark, path, KIND, True).collect()), key=repr) == want
    return want


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_single_task_reader(spark, tmp_path, narrow, end):
    rng = random.Random(3)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_bytes(content(rng, 40, end).encode())
    want = []
    for path in tmp_path.iterdir():
        rows = list(csv.reader(io.StringIO(path.read_bytes().decode(), newline="")))
        want += [(a, int(b), c) for a, b, c in rows[1:]]
    for size in (37, 200, 100_000):
        narrow(size)
        got = readers.csv_typed(spark, str(tmp_path), KIND, True).collect()
        assert sorted(map(tuple, got)) == sorted(want)
        if end == "\n":  # else Spark's reader drops some \r inside quotes
            assert len(same(spark, str(tmp_path))) == 120


def test_a_quote_at_every_range_edge(spark, tmp_path, narrow):
    """Records of one size, moved byte by byte over the edges of ranges."""
    for shift in range(12):
        path = tmp_path / f"{shift}.csv"
        rows = "".join(f'"{i:02d}\n""q",{i},"z\n"\n' for i in range(30))
        path.write_bytes(("a,b,c\n" + f'"{"s" * shift}",0,""\n' + rows).encode())
    narrow(16)
    assert len(same(spark, str(tmp_path))) == 12 * 31
    assert splitcsv.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 100


def test_many_tasks_and_long_records(spark, tmp_path, narrow):
    """One record that covers several ranges, one that ends the file without a line break."""
    (tmp_path / "x.csv").write_bytes(
        ('a,b,c\n"' + "long\n" * 300 + '",1,"x"\nplain,2,\n,3,"open ""end""\nhere"').encode())
    (tmp_path / "header.csv").write_bytes(b"a,b,c\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b'a,b,c\n\n"y",4,""\n\n')
    narrow(64)
    assert [r[1] for r in sorted(same(spark, str(tmp_path)), key=lambda r: r[1])] == [1, 2, 3, 4]


def test_a_malformed_value_stops_the_load(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b'a,b,c\n"m\nn",no number,""\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.csv_typed(spark, str(tmp_path), KIND, True).collect()


def test_batches_cut_records_as_well(spark, tmp_path):
    rng = random.Random(8)
    (tmp_path / "x.csv").write_bytes(content(rng, 60).encode())
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    keep = spark.conf.get(key)
    try:
        for rows in ("1", "2", "7"):
            spark.conf.set(key, rows)
            same(spark, str(tmp_path))
    finally:
        spark.conf.set(key, keep)
