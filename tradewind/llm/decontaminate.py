"""Benchmark decontamination: short test items found inside long documents.

Items and documents are cut into shingles of `WIDTH` lower-cased words (items with fewer
words: all their words, looked for at that width). Items are partitioned by size: those
with 2^c to 2^(c+1)-1 distinct shingles share a sketch size k, the least with
k > (1 - threshold) * largest size of the class. An item's sketch is its k smallest
shingle hashes. A document with at least the threshold's share of an item's shingles
misses fewer than k of them, so it holds one of the sketch, wherever they stand: the
sketch search loses nothing at any document length. Candidates are verified by their
exact shingle texts.

The items are the stated query set: they are held by every task, in blocks of at most
`BLOCK_CHARS` characters, one pass over the documents a block.

Null and empty texts match nothing. Repeated documents each get their rows, repeated
items each count. Null ids stay null.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import texts
from tradewind.llm.words import forget, hashes, rolling

WIDTH, THRESHOLD = 5, 0.8
BLOCK_CHARS = 8_000_000
WORD = re.compile(r"\w+").findall


def shingles(words: list[str], width: int) -> set[str]:
    return {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


class Index:
    """A block of items, by shingle width: sketch hashes, the items of each, their shingles."""

    def __init__(self, items: list[tuple[str | None, str]], threshold: float):
        self.threshold = threshold
        self.items: list[tuple[str | None, set[str]]] = []
        holders: dict[int, defaultdict[int, list[int]]] = {}
        for item_id, text in items:
            words = WORD(text.lower())
            width = min(WIDTH, len(words))
            if not width:
                continue
            own = shingles(words, width)
            largest = (1 << len(own).bit_length()) - 1  # of the item's size class
            k = math.floor((1 - threshold) * largest + 1e-9) + 1
            number = len(self.items)
            self.items.append((item_id, own))
            sketch = np.unique(rolling(hashes(words), width))[:k]
            for h in sketch.tolist():
                holders.setdefault(width, defaultdict(list))[h].append(number)
        self.sketches = {w: np.array(sorted(h), np.uint64) for w, h in holders.items()}
        self.holders = holders

    def hits(self, text: str) -> list[tuple]:
        words = WORD(text.lower())
        if not words or not self.items:
            return []
        word_hashes, candidates = hashes(words), {}
        for width, sketch in self.sketches.items():
            if len(words) < width:
                continue
            found = rolling(word_hashes, width)
            at = np.minimum(np.searchsorted(sketch, found), len(sketch) - 1)
            for h in set(found[sketch[at] == found].tolist()):
                for number in self.holders[width][h]:
                    candidates[number] = width
        if not candidates:
            return []
        of_width = {w: shingles(words, w) for w in set(candidates.values())}
        out = []
        for number, width in sorted(candidates.items()):
            item_id, own = self.items[number]
            shared = len(own & of_width[width])
            if shared >= self.threshold * len(own) - 1e-9:
                out.append((item_id, len(own), shared))
        return out


_indexes: dict[tuple[str, float], Index] = {}


def item_blocks(items: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[tuple[str, list]]:
    rows = texts(items, "item_id").withColumn("doc_id", F.col("doc_id").cast("string"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // chars))
    for i in range(count):
        block = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == i)
        # A block of the query set, with a name of its own.
        yield uuid.uuid4().hex, [(r.doc_id, r.text) for r in block.collect()]


def index_of(block: Broadcast, threshold: float) -> Index:
    """A worker keeps the index of one block."""
    name, items = block.value
    if (name, threshold) not in _indexes:
        _indexes.clear()
        _indexes[name, threshold] = Index(items, threshold)
    return _indexes[name, threshold]


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): one row for each document
    that holds at least the threshold's share of an item's distinct shingles."""
    def search(block: Broadcast) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = index_of(block, threshold)
            for batch in batches:
                found = [(doc_id, *hit) for doc_id, text in
                         zip(batch["doc_id"], batch["text"], strict=True)
                         for hit in index.hits(text)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "n_shingles", "n_shared"])

        return texts(docs).withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
            run, "doc_id string, item_id string, n_shingles long, n_shared long")

    share = docs.sparkSession.sparkContext.broadcast
    found = reduce(DataFrame.unionByName, [search(share(b)) for b in item_blocks(items)])
    return found.select(F.col("doc_id").cast("long"), F.col("item_id").cast("long"), "n_shingles",
                        "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
          text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item."""
    def holds(block: Broadcast):
        @F.pandas_udf(T.BooleanType())
        def held(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            index = index_of(block, threshold)
            for part in parts:
                yield part.map(lambda text: bool(index.hits(text))).astype(bool)
            forget()

        return held(F.coalesce(F.col(text_col).cast("string"), F.lit("")))

    share = docs.sparkSession.sparkContext.broadcast
    found = [holds(share(b)) for b in item_blocks(items)]
    return docs.filter(~reduce(lambda a, b: a | b, found))
