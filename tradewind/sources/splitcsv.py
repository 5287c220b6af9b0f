"""CSV files whose records hold quoted line breaks, read by many tasks.

A reader that starts inside a file cannot tell whether a line break ends a record: that
depends on every quote before it. So quotes are counted first, per byte range; the parity of
all earlier ranges of the file then says whether a range begins inside quotes. With it,
each range is cut into records on its own: a line starts a record where an even number of
quotes lies before it. Only what the range borders cut apart, at most two pieces a range, is
put together again across ranges. The records are parsed by the built-in CSV function.

Both passes read lines of the plain text source, whose ranges and row order within a range
they rely on; a file that is cut into other ranges in the second pass is an error. One
row a range is broadcast.

Quotes must follow the usual rule: they only enclose fields, and are doubled inside. Records end with
\\n or \\r\\n. Each file begins with a header. An unclosed quote reaches to the end of its file. Empty lines
are no records. A file without any line gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECES = "file string, start long, place int, part int, text string"
WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of one that began earlier; the begin of one


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text, file, start): the lines of each byte range, in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))


def parities(rows: DataFrame) -> DataFrame:
    """(file, start, odd): whether a range begins inside quotes."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    counted = rows.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast(
        "int").alias("odd"))


def _range(text: np.ndarray, odd: int, place: int) -> Iterator[tuple]:
    """(place, part, text) of one batch of a range that begins with `odd` quotes open."""
    quotes = np.array([t.count('"') for t in text])
    open_before = (odd + np.cumsum(quotes) - quotes) % 2
    starts = np.flatnonzero(open_before == 0)
    open_at_end = (odd + quotes.sum()) % 2
    cuts = np.unique(np.concatenate([[0], starts, [len(text)]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        begun = open_before[a] == 0
        ended = b < len(text) or not open_at_end
        kind = (WHOLE if begun else HEAD) if ended else TAIL
        yield place + a, (kind, bool(begun)), text[a] if b == a + 1 else "\n".join(text[a:b])


def pieces(rows: DataFrame) -> DataFrame:
    """(file, start, place, part, text) of rows(text, file, start, odd): records, and the pieces of
    those that go over a border. place orders a range's pieces, the header has 0 in range 0."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, odd, place, held = None, 0, 0, None  # held: lines of an open record of this range

        def close() -> Iterator[tuple]:
            if held is not None:
                yield (*at, held[0], TAIL if held[1] else HEAD, "\n".join(held[2]))

        for batch in batches:
            out = []
            border = np.flatnonzero((batch["file"].ne(batch["file"].shift())
                                     | batch["start"].ne(batch["start"].shift())).to_numpy())
            for a, b in zip(border.tolist(), [*border.tolist()[1:], len(batch)], strict=True):
                first = batch.iloc[a]
                here = first["file"], int(first["start"])
                if here != at:
                    out += close()
                    at, odd, place, held = here, int(first["odd"]), 0, None
                text = batch["text"].to_numpy()[a:b]
                for where, (kind, begun), value in _range(text, odd, place):
                    if held is not None:  # goes on from the batch before
                        held[2].append(value)
                        if kind != TAIL:
                            out.append((*at, held[0], WHOLE if held[1] else HEAD, "\n".join(held[2])))
                            held = None
                    elif kind == TAIL:
                        held = (where, begun, [value])
                    else:
                        out.append((*at, where, kind, value))
                place += len(text)
                odd = (odd + sum(t.count('"') for t in text)) % 2
            yield pd.DataFrame(out, columns=["file", "start", "place", "part", "text"])
        last = list(close())
        if last:
            yield pd.DataFrame(last, columns=["file", "start", "place", "part", "text"])

    return rows.mapInPandas(run, PIECES)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text, header): every record of the files as one string."""
    rows = lines(spark, path)
    known = rows.join(F.broadcast(parities(rows)), ["file", "start"], "left").withColumn(
        "odd", F.coalesce("odd", F.raise_error(F.lit("the file ranges changed between the passes")).cast("int")))
    found = pieces(known.select("text", "file", "start", "odd"))
    header = (F.col("start") == 0) & (F.col("place") == 0)
    whole = found.filter(F.col("part") == WHOLE).select("text", header.alias("header"))
    # At most two pieces a range: each record's begin numbers it and the ends that follow.
    order = Window.partitionBy("file").orderBy("start", "place")
    cut = found.filter(F.col("part") != WHOLE).withColumn("record", F.sum(
        (F.col("part") == TAIL).cast("int")).over(order))
    joined = cut.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    first = (F.col("p")[0]["start"] == 0) & (F.col("p")[0]["place"] == 0)
    return whole.unionByName(joined.select(text.alias("text"), first.alias("header")))


def read(spark: SparkSession, path: str | list[str], columns: T.StructType, options: dict) -> DataFrame:
    """The rows of the files; `options` are those of the CSV reader."""
    ended = F.regexp_replace("text", r"\r\z", "")
    kept = records(spark, path).filter("not header").select(ended.alias("text")).filter("text <> ''")
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    options = {k: v for k, v in options.items() if k != "header"} | {"multiLine": "true"}
    return kept.select(F.from_csv("text", columns.simpleString(), options).alias("r")).select("r.*")
