"""Line dedup by pairwise alignment.

Documents are ordered by (id, hash of the text); null ids come last. Every line of at
least `MIN_WORDS` words links a document to the nearest earlier one that holds it
(`links`), however many hold it. Neighbouring lines of which one has fewer than `LONG` words
link as one key too, so they need not name the same partner one by one. Every such pair is aligned: patience diff
aligns the pair's line hashes, and what lies in common blocks is deleted from the later
document; a line goes if any of the document's pairs deletes it. The lines of exact
copies all go, but for the first copy's.

Null and empty texts stay as they are. Rows with equal id and text are one document and
get the same result. Blank lines go only inside a common block. Line hashes have 128 bits.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import stored
from tradewind.llm.links import linked

MIN_WORDS, LONG = 3, 8
HASH = 16


def document(id_col: str, text_col: str) -> Column:
    """The ordered key of a row; none of its fields is ever null."""
    number, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return F.struct(number.isNull().alias("no_id"), F.coalesce(number, F.lit(0)).alias("id"),
                    F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"))


@F.pandas_udf(T.StructType().add("lines", T.BinaryType()).add("keys", T.ArrayType(T.BinaryType()))
              .add("pairs", T.ArrayType(T.BinaryType())))
def line_hashes(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The hashes of all lines, joined, the distinct ones of lines that link, and those of
    neighbouring lines."""
    import xxhash

    for part in parts:
        rows = []
        for text in part:
            lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
            hashes = [xxhash.xxh3_128_digest(line.strip()) for line in lines]
            keys, pairs, last = {}, {}, None
            for h, line in zip(hashes, lines, strict=True):
                n = len(line.split())
                if n < MIN_WORDS:
                    continue
                keys[h] = None
                if last and min(n, last[1]) < LONG:
                    pairs[xxhash.xxh3_128_digest(last[0] + h)] = None
                last = h, n
            rows.append((b"".join(hashes), list(keys), list(pairs)))
        yield pd.DataFrame(rows, columns=["lines", "keys", "pairs"])


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing run of values, by patience piles."""
    tops, at, back = [], [], []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Patience diff: pairs of equal lines (i in a, j in b), both increasing."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        unique = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        anchors = [unique[k] for k in increasing([j for _, j in unique])]
        if not anchors:
            continue
        for (i, j), (i1, j1) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if i1 < a1:
                out.append((i1, j1))
            todo.append((i + 1, i1, j + 1, j1))
    return sorted(out)


def split(lines: bytes) -> list[bytes]:
    return [lines[i:i + HASH] for i in range(0, len(lines), HASH)]


@F.pandas_udf(T.BinaryType())
def deleted(later: pd.Series, earlier: pd.Series) -> pd.Series:
    """Bitmap of the later document's lines that lie in common blocks."""
    out = []
    for a, b in zip(later, earlier, strict=True):
        flags = np.zeros(len(a) // HASH, bool)
        flags[[i for i, _ in aligned(split(a), split(b))]] = True
        out.append(np.packbits(flags).tobytes())
    return pd.Series(out)


@F.pandas_udf(T.BinaryType())
def joined(bitmaps: pd.Series) -> pd.Series:
    return bitmaps.map(lambda maps: np.bitwise_or.reduce(
        [np.frombuffer(m, np.uint8) for m in maps]).tobytes())


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("n_removed", T.LongType()))
def without(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, bitmaps, copies in parts:
        rows = []
        for text, bitmap, copy in zip(texts, bitmaps, copies, strict=True):
            if copy and text:
                rows.append(("", text.count("\n") + 1))
            elif bitmap is None:
                rows.append((text, 0))
            else:
                lines = text.split("\n")
                gone = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(lines))
                rows.append(("\n".join(x for x, g in zip(lines, gone, strict=True) if not g),
                             int(gone.sum())))
        yield pd.DataFrame(rows, columns=["text", "n_removed"])


def overlaps(lines: DataFrame) -> DataFrame:
    """(doc, partner) to align, from lines(doc, lines, keys, pairs)."""
    keys = F.explode(F.concat("keys", "pairs")).alias("key")
    links = linked(lines.select("doc", keys).withColumn("at", F.lit(0)))
    return links.select("doc", "partner").distinct()


def removals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, bitmap, copy) of the documents that lose lines."""
    rows = stored(docs.select(document(id_col, text_col).alias("doc"),
                              line_hashes(F.col(text_col).cast("string")).alias("x"))
                  .select("doc", "x.*"), "lines")
    first = stored(rows.groupBy(F.col("doc.hash").alias("hash")).agg(F.min("doc").alias("doc")),
                   "first")
    lines = stored(rows.join(first.select("doc"), "doc").dropDuplicates(["doc"]), "firsts")
    pairs = stored(overlaps(lines), "pairs")
    later = pairs.join(lines.select("doc", F.col("lines").alias("later")), "doc")
    both = later.join(lines.select(F.col("doc").alias("partner"), F.col("lines").alias("earlier")),
                      "partner")
    bitmaps = stored(both.select("doc", deleted("later", "earlier").alias("bitmap")), "bitmaps")
    own = bitmaps.groupBy("doc").agg(F.collect_list("bitmap").alias("maps")).select(
        "doc", joined("maps").alias("bitmap"), F.lit(False).alias("copy"))
    copies = rows.select("doc").distinct().join(first.select("doc"), "doc", "left_anti").select(
        "doc", F.lit(None).cast("binary").alias("bitmap"), F.lit(True).alias("copy"))
    return stored(own.unionByName(copies), "removals")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with what is left of their texts, and `n_removed` lines."""
    names = docs.columns
    gone = removals(docs, id_col, text_col)
    rows = docs.select(F.struct("*").alias("row"), document(id_col, text_col).alias("doc"))
    text = F.col(f"row.`{text_col}`").cast("string")
    # `gone` grows with the documents: a merge join at every size.
    done = (rows.join(gone.hint("merge"), "doc", "left")
            .select("row", without(text, "bitmap", F.coalesce("copy", F.lit(False))).alias("x")))
    return done.select(*[F.col("x.text") if n == text_col else F.col(f"row.`{n}`") for n in names],
                       F.col("x.n_removed").alias("n_removed"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_removed."""
    return dedup(docs.select("doc_id", "text"))
