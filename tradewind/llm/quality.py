"""Quality rules: base counts of a text, and a likelihood ratio against trusted texts.

Words and punctuation runs, and pairs of neighbours, are hashed into `BUCKETS` counts.
One multinomial is fitted to the trusted documents, one to the whole corpus, both with
add-one smoothing; a text's score is the mean log ratio of its n-grams. Half of the
labelled documents (by a hash of the id) are the trusted target, the other half sets the
threshold: the score that best divides trusted from rejected labels among the texts that
pass the base rule, where losing a trusted one weighs `LOSS` times. Every document is scored whole and compared with that one number.

Null and empty texts have no words and fail the base rule. Rows are independent, so
repeated rows give the same result again; a null id is never labelled. Without trusted
documents, or without both kinds of labels, the base rule alone decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import blocks, free_name, stored, texts

BUCKETS = 1 << 14
MIN_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+").findall
STEPS, LOW, HIGH = 4000, -20.0, 20.0  # of the histogram of scores
MOST_LABELLED = 100_000  # labelled documents that the target and the threshold are fitted to
LOSS = 5
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at exactly \\x20 and \\x09-\\x0d
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(data.count(bytes([c])) for c in SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
        count = Counter(windows)
        if len(count) < len(windows):
            hit = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero([count[w] > 1 for w in windows])
            np.add.at(hit, at, 1)
            np.add.at(hit, at + WINDOW, -1)
            repeated = int((np.cumsum(hit) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated



_hashes: dict[bytes, int] = {}


def ngrams(text: str) -> np.ndarray:
    """Buckets of the lower-cased tokens and of the pairs of neighbours."""
    tokens = TOKEN(text.encode("utf-8", "surrogatepass").lower())
    if len(_hashes) > 200_000:
        _hashes.clear()
    for token in set(tokens):
        if token not in _hashes:
            _hashes[token] = zlib.crc32(token)
    one = np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([one * np.uint64(0x9E3779B97F4A7C15), two])
            >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def score(text: str, ratio: np.ndarray) -> float:
    """Mean log ratio; a text without n-grams scores 0."""
    found = ngrams(text)
    return float(ratio[found].mean()) if len(found) else 0.0


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(bucket, raw, target) over all rows of docs(text, trusted)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for block in blocks(batches):
            for text, trusted in zip(block["text"], block["trusted"], strict=True):
                count = np.bincount(ngrams(text), minlength=BUCKETS)
                raw += count
                if trusted:
                    target += count
        _hashes.clear()  # workers live on and serve other operators
        seen = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})

    return (docs.mapInPandas(run, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def labelled(labels: DataFrame, most: int) -> DataFrame:
    """(id, good, train): at most `most` labelled ids, picked by a hash of the id. good:
    quality 1 and not toxic; bad: quality 0; others are no example of either."""
    one = (labels.filter("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(
            F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")))
    return (one.filter("q = 0 or t = 0")
            .select("id", (F.col("q") > 0).alias("good"), F.xxhash64("id").alias("h"))
            .orderBy("h", "id").limit(most)
            .select("id", "good", (F.col("h") % 2 == 0).alias("train")))


def best_threshold(bins: list[tuple[int, bool, int]]) -> float | None:
    """The lowest bin edge with the most rejects caught, less `LOSS` times the trusted lost."""
    good, bad = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
    for at, is_good, n in bins:
        (good if is_good else bad)[at] += n
    if not good.sum() or not bad.sum():
        return None
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(bad)]) / bad.sum()
    return LOW + int(np.argmax(caught - LOSS * lost)) * (HIGH - LOW) / STEPS


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED
        ) -> tuple[np.ndarray | None, float | None]:
    """(log ratio of each bucket, threshold). The corpus counts cover every document; at
    most `most` labelled ones, a set small enough to broadcast, are the examples."""
    known = F.broadcast(stored(labelled(labels, most), "labels"))
    marked = texts(docs).join(known, F.col("doc_id") == F.col("id"), "left")
    counts = corpus_counts(marked.select(
        "text", F.coalesce(F.col("good") & F.col("train"), F.lit(False)).alias("trusted")))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():  # one row a bucket at most
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not target.sum():
        return None, None
    ratio = (np.log((target + 1) / (target.sum() + BUCKETS))
             - np.log((raw + 1) / (raw.sum() + BUCKETS)))
    # Stored before it is measured: a filter or join beside a Python function may be moved
    # so that the function runs twice or on every document. So failures are left out last.
    examples = stored(marked.filter("good is not null and not train").select("text", "good"), "examples")
    tested = judged(examples, F.col("text"), (ratio, None))
    at = F.floor((F.col("m.score") - LOW) / ((HIGH - LOW) / STEPS))
    bins = tested.select("good", F.greatest(F.lit(0), F.least(F.lit(STEPS), at)).alias("at"),
                         F.col("m.base_failed").alias("failed")).groupBy("at", "good", "failed")
    return ratio, best_threshold([(r["at"], r["good"], r["n"]) for r in bins.agg(
        F.count("*").alias("n")).collect() if not r["failed"]])


def scorer(docs: DataFrame, ratio: np.ndarray | None):
    """A function of a text column: struct of the base counts and the score."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf(T.StructType.fromDDL(BASE + ", score double"))
    def measured(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(*base_counts(x), score(x, shared.value) if shared.value is not None else 0.0)
                    for x in part]
            yield pd.DataFrame(rows, columns=NAMES).astype({"score": "float64"})
        _hashes.clear()

    return measured


def judged(frame: DataFrame, text: Column, model: tuple, name: str = "m") -> DataFrame:
    """`frame` and a struct column of counts, score, base_failed, kept."""
    ratio, threshold = model
    failed = (F.col(f"{name}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{name}.n_repeat_words") > REPEATED_PERCENT * F.col(f"{name}.n_words"))
    enough = F.lit(True) if threshold is None else F.col(f"{name}.score") >= threshold
    return frame.withColumn(name, scorer(frame, ratio)(text)).withColumn(name, F.struct(
        f"{name}.*", failed.alias("base_failed"), (~failed & enough).alias("kept")))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, score."""
    rows = judged(texts(docs), F.col("text"), fit(docs, labels))
    return rows.select("doc_id", *[f"m.{c}" for c in NAMES[:-1]], "m.base_failed", "m.kept",
                       "m.score")


def keep(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass."""
    name = free_name(docs, "judged")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return judged(docs, text, fit(docs, labels), name).filter(f"{name}.kept").drop(name)
