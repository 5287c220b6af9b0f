"""Importance resampling of documents towards a target set.

Features are all runs of 1 to `MOST` words, hashed by CRC-32 into buckets. A text is lower-cased
(A-Z only), its separators become single spaces, and one overlapped regex scan stops at
every word boundary and emits the span of the longest run there; the spans of the shorter
runs end where the next matches start. CRCs are taken over the spans in numpy: byte by byte for words, and a longer
run's from those of its words (the CRC of joined bytes is the first one shifted by
the length of the second, xor the second).

Counts over all documents and all target texts give a bucket's gain, floor(1000 * log of
the smoothed target share over the corpus share). A document's weight is the sum of its
gains; with a Gumbel variate from a hash of its id as score, the highest scores are a sample
without replacement with probabilities that follow the weights. The cut and the ranks are
exact at every size: the cut is found by counting, only drawn rows are ordered.

The scan is the expensive part and is done once: buckets (two bytes a feature) are stored in
the shared folder, then counted, then weighed. A task holds the spans and buckets of a block
of `BLOCK` characters, or of one document if that is longer. Broadcast: one gain per bucket.

Null and empty texts have no feature, weight 0, and are never drawn (too few words). A null
doc_id is hashed as an empty id and comes first among ties. Repeated rows share weight and
score; which of them is drawn when the sample ends between them is left open. An empty
target set or an empty corpus gives gains by the same rule, with zero counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain
from operator import methodcaller

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import blocks, stored, texts
from tradewind.operators import rank

BUCKETS, MOST, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
BLOCK = 1_000_000  # characters scanned as one string
# Letters and digits of ASCII and all bytes above it belong to words; A-Z become a-z.
FOLDED = bytes(c if c >= 128 or bytes([c]).isalnum() else 32 for c in range(256)).lower()
#: The longest run of up to `MOST` words at a boundary; the next match is the next boundary.
RUNS = rb" [^ ]++(?: [^ ]++){0,%d}+(?= )" % (MOST - 1)
LENGTHS = 256  # longer words take the plain CRC


def shifts() -> np.ndarray:
    """[length, byte position, byte]: a CRC's share after `length` more zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    step = one.copy()
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    out = np.empty((LENGTHS, 4, 256), np.uint32)
    out[0] = [one << np.uint32(8 * k) for k in range(4)]
    for n in range(1, LENGTHS):
        out[n] = step[out[n - 1] & 255] ^ (out[n - 1] >> np.uint32(8))
    return out


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRCs of joined byte strings; `length` is that of the second."""
    out = second.copy()
    for k in range(4):
        out ^= table[length, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class Scanner:
    """The buckets of all runs of words of a text."""

    def __init__(self, buckets: int = BUCKETS):
        import regex

        self.runs = regex.compile(RUNS)
        self.table = shifts()
        self.buckets = np.uint32(buckets)

    def __call__(self, texts: list[str]) -> list[tuple[int, np.ndarray]]:
        """(words, bucket of each feature) of each text; a run counts as often as it occurs.
        All are scanned as one string; two spaces, which no run crosses, part them."""
        parts = [b" " + b" ".join(x.encode("utf-8", "surrogatepass").translate(FOLDED).split())
                 for x in texts]
        data = b" ".join(parts) + b" "
        found = map(methodcaller("span"), self.runs.finditer(data, overlapped=True))
        starts, ends = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2).T
        kinds = [(crc % self.buckets).astype(np.uint16) for crc in self.crcs(data, starts + 1, ends)]
        words = np.diff(np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts])), prepend=0)
        cut = [np.split(kind, np.cumsum(np.maximum(words - n, 0))) for n, kind in enumerate(kinds)]
        return [(int(n), np.concatenate(own)) for n, *own in zip(words, *cut, strict=False)]

    def crcs(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """CRCs of all runs of one word, of two, of three. `ends` are those of the longest run
        at each start; a shorter one ends before the next start that it covers."""
        after = [np.append(starts[n:], np.full(min(n, len(starts)), len(data) + 1)) for n in (1, 2)]
        size = np.where(after[0] < ends, after[0] - 1, ends) - starts
        word = self.words(data, starts, size)
        usual = size < LENGTHS - 1
        spaced = joined(np.full(len(word), zlib.crc32(b" "), np.uint32), word,
                        np.where(usual, size, 0), self.table)
        run = word.copy()
        yield word
        for n, following in enumerate(after, 1):
            at = np.flatnonzero(following < ends)
            run[at] = joined(run[at], spaced[at + n], np.where(usual[at + n], size[at + n] + 1, 0), self.table)
            for i in at[~usual[at + n]].tolist():
                run[i] = zlib.crc32(data[starts[i]:starts[i + n] + size[i + n]])
            yield run[at]

    def words(self, data: bytes, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """CRCs of single words, one byte of all words at a time, the longest words first."""
        step, held = self.table[1, 0], np.frombuffer(data, np.uint8)
        order = np.argsort(-size, kind="stable")
        start, length = starts[order], size[order]
        many = int(np.searchsorted(-length, -LENGTHS, side="right"))  # of that size and longer
        crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
        alive = np.searchsorted(-length, -np.arange(LENGTHS), side="left")  # longer than k
        for k in range(int(length[many]) if many < len(length) else 0):
            part = crc[many:alive[k]]
            crc[many:alive[k]] = step[(part ^ held[start[many:alive[k]] + k]) & np.uint32(255)] ^ (
                part >> np.uint32(8))
        crc ^= np.uint32(0xFFFFFFFF)
        for i in range(many):
            crc[i] = zlib.crc32(data[start[i]:start[i] + length[i]])
        out = np.empty_like(crc)
        out[order] = crc
        return out


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets): the buckets of all features as 16-bit numbers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("1 to 65,536 buckets")

    @F.pandas_udf("n_words long, buckets binary")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scan = Scanner(buckets)
        for batch in batches:
            found = [pair for part in blocks([batch.to_frame("text")], chars=BLOCK)
                     for pair in scan(part["text"].tolist())]
            yield pd.DataFrame({"n_words": np.array([n for n, _ in found], np.int64),
                                "buckets": [b.tobytes() for _, b in found]})

    rows = texts(docs, id_col, text_col).withColumn("found", scanned("text"))
    return rows.select("doc_id", "found.n_words", "found.buckets")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows; one number a bucket reaches the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch["buckets"]:
                total += np.bincount(np.frombuffer(held, np.uint16), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    counts = features.select("buckets").mapInPandas(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio of the add-one shares), target over corpus."""
    b, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((int(y) + 1) * (s + b) / ((int(x) + 1) * (t + b))))
                     for x, y in zip(corpus, target, strict=True)], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight)."""
    shared = features.sparkSession.sparkContext.broadcast(gain)

    @F.pandas_udf(T.LongType())
    def weight(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([int(shared.value[np.frombuffer(b, np.uint16)].sum()) for b in part], dtype="int64")

    return features.select("doc_id", "n_words", (F.length("buckets") / 2).cast("long").alias("n_features"),
                           weight("buckets").alias("weight"))


def scored(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """`rows` and score: weight plus 1000 times a Gumbel variate that the id decides."""
    ident = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(ident.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = -1000 * F.log(-F.log((h + 0.5) / 4294967296.0))
    return rows.withColumn("score", F.col("weight") + F.floor(gumbel).cast("long"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank 1, 2, … of the drawn
    ones by falling score, ties by doc_id, null for the others."""
    features = stored(featured(docs, id_col, text_col), "features")
    wanted = featured(target.select(F.lit(None).cast("long").alias("id"), F.col("text")), "id")
    rows = scored(weighed(features, gains(bucket_counts(features), bucket_counts(wanted))), seed)
    rows = stored(rows, "scores")
    eligible = rows.filter(F.col("n_words") >= min_words)
    draw = percent * eligible.count() // 100
    names = ["doc_id", "n_features", "weight", "score"]
    nobody = F.lit(None).cast("long").alias("rank")
    if not draw:
        return rows.select(*names, nobody)
    order = [-F.col("score"), F.col("doc_id")]
    cut = rank.tuples_at_ranks(eligible, order, lambda n: [draw])[0]
    inside = (F.col("n_words") >= min_words) & (
        F.struct(order[0].alias("k0"), order[1].alias("k1")) <= cut)
    placed = rank.with_running(rows.filter(inside), order, F.lit(1))
    place = F.when(F.col("position") <= draw, F.col("position")).cast("long").alias("rank")
    return rows.filter(~inside).select(*names, nobody).union(placed.select(*names, place))
