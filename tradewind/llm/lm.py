"""Language-model scores: a word unigram base, and a causal self-attention model.

Documents whose crc32(id) mod 7 is not 2 are the training part; the rest is held out.

Base: words (and one end a document) with add-one smoothing over the training counts. The
`FREQUENT` most frequent words at most are broadcast; the other words of a document meet
the table of counts in a join, so every word counts whatever the size of the vocabulary.

Model: texts, lower-cased in A-Z, become subword ids of a public vocabulary, which are
never trained. Ids are counted over all training documents. The attention weights
(`attention`) start from a fit to at most `WARM` training documents; then every task goes
once over its part of all training ids, and the weights of all tasks are averaged by the
number of ids. Every document is scored whole in overlapping windows, each id once.

Null and empty texts are just the end. Rows are independent: repeated rows are scored
alike and each counts in training; a null id counts as an empty one for the split. With no
training rows nothing is known: counts are 0 and the model keeps its first weights.
"""

from __future__ import annotations

import base64
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.attention import Coding, Trainer, flat, initial, leaders, score, shaped
from tradewind.llm.frames import blocks, stored, texts

FREQUENT, WARM, WARM_WORDS, RATE = 100_000, 1_000, 500_000, 0.01
MODULUS, HELD_OUT = 7, 2
KEPT_WORDS, KEPT_IDS = 1_000_000, 200_000

_kept: dict[str, object] = {}


def once(name: str, make):
    """A worker's copy of something made from a broadcast."""
    if name not in _kept:
        if len(_kept) > 3:
            _kept.clear()
        _kept[name] = make()
    return _kept[name]


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all rows of train(text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: Counter = Counter()

        def out() -> pd.DataFrame:
            frame = pd.DataFrame({"word": list(count), "n": list(count.values())},
                                 columns=["word", "n"]).astype({"n": "int64"})
            count.clear()
            return frame

        for block in blocks(batches):
            for text in block["text"]:
                count.update(words(text))
            if len(count) > KEPT_WORDS:
                yield out()
        yield out()

    return train.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def cut_off(counts: DataFrame, most: int) -> int:
    """The least count such that no more than `most` words have it or more."""
    classes = counts.groupBy("n").agg(F.count("*").alias("words"))
    low, total = None, 0
    for n, size in sorted(map(tuple, classes.collect()), reverse=True):
        total += size
        if total > most:
            break
        low = n
    return low if low is not None else 1 << 62


def based(docs: DataFrame, counts: DataFrame, end_count: int, ranks: bytes, pattern: str,
          most: int) -> tuple[DataFrame, DataFrame]:
    """Rows (uid, doc_id, held_out, ids, n_tokens, n_known, log_sum) by the frequent words,
    and (uid, n_known, log_sum) by the others, where a row has any."""
    spark, cut = docs.sparkSession, cut_off(counts, most)
    top = counts.filter(F.col("n") >= cut).toPandas()  # at most `most` words
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, bytes_list(top["word"]),
                                           top["n"].to_numpy(np.int64), ranks))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, known, n, lines = shared.value
        value = once(name, lambda: dict(zip(known, np.log10(n + 1.0).tolist(), strict=True)))
        encode = once(name + pattern, lambda: encoding(lines, pattern)).encode_to_numpy
        ending = math.log10(end_count + 1)
        for block in blocks(batches):
            rows = []
            for doc_id, held_out, text in block.itertuples(index=False):
                low = text.encode("utf-8", "surrogatepass").lower()
                found = low.split()
                logs, rare = list(map(value.get, found)), []
                if None in logs:
                    rare = [w for w, x in zip(found, logs, strict=True) if x is None]
                    logs = [x for x in logs if x is not None]
                ids = encode(low.decode("utf-8", "replace"))
                rows.append((doc_id, held_out, ids.astype("<u4", copy=False).tobytes(), len(found) + 1,
                             len(logs) + (end_count > 0), ending + math.fsum(logs), rare))
            yield pd.DataFrame(rows, columns=["doc_id", "held_out", "ids", "n_tokens", "n_known",
                                              "log_sum", "rare"])

    rows = stored(docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        run, "doc_id string, held_out boolean, ids binary, n_tokens long, n_known long, "
             "log_sum double, rare array<binary>").withColumn("doc_id", F.col("doc_id").cast("long"))
        .withColumn("uid", F.monotonically_increasing_id()), "based")
    rare = (rows.select("uid", F.explode("rare").alias("word"))
            .join(counts.filter(F.col("n") < cut), "word").groupBy("uid")
            .agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more_sum")))
    return rows.drop("rare"), rare


def bytes_list(column: pd.Series) -> list[bytes]:
    return [bytes(x) for x in column]


def encoding(lines: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def portions(ids: pd.Series) -> Iterator[list[np.ndarray]]:
    """Id arrays of a batch in lists of about `KEPT_IDS` ids."""
    part, size = [], 0
    for data in ids:
        part.append(np.frombuffer(data, "<u4").astype(np.int64))
        size += len(part[-1])
        if size >= KEPT_IDS:
            yield part
            part, size = [], 0
    if part:
        yield part


def id_counts(train: DataFrame, size: int, before: np.ndarray | None = None) -> np.ndarray:
    """Counts of all ids and ends over train(ids), or of each after each group of ids;
    `before` names the groups. At most groups * vocabulary numbers."""
    groups = 1 if before is None else int(before.max()) + 1
    shared = train.sparkSession.sparkContext.broadcast(before)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _kept.clear()  # of the pass before: the worker needs neither words nor ranks now
        count = np.zeros(groups * size, np.int64)
        end = np.array([size - 1])
        for batch in batches:
            for part in portions(batch["ids"]):
                ids = np.concatenate([x for ids in part for x in (ids, end)])
                if shared.value is not None:
                    ids = ids + shared.value[np.concatenate([end, ids[:-1]])] * size
                count += np.bincount(ids, minlength=len(count))
        seen = np.flatnonzero(count)
        yield pd.DataFrame({"id": seen, "n": count[seen]})

    found = train.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).toPandas()
    total = np.zeros(groups * size, np.int64)
    total[found["id"].to_numpy(np.int64)] = found["n"]
    return total.reshape(groups, size) if before is not None else total


def trained(train: DataFrame, coding: Coding, weights: dict, end: int, rate: float) -> dict:
    """Each task goes over its rows of train(ids) once; the average of all, by ids seen."""
    shared = train.sparkSession.sparkContext.broadcast((coding, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coded, start = shared.value
        trainer = Trainer(start, rate)
        for batch in batches:
            for part in portions(batch["ids"]):
                trainer.learn(coded, part, end)
        if trainer.tokens:
            values = flat(trainer.w).astype(np.float64) * trainer.tokens
            yield pd.DataFrame({"i": np.arange(len(values)), "value": values, "n": trainer.tokens})

    rows = train.select("ids").mapInPandas(run, "i int, value double, n long").groupBy("i").agg(
        (F.sum("value") / F.sum("n")).alias("x")).toPandas()  # one row for each weight
    return shaped(rows.sort_values("i")["x"].to_numpy()) if len(rows) else weights


def first_fit(train: DataFrame) -> DataFrame:
    """The rows of the first fit, in one task: `WARM` of them by a hash, or as many as hold
    `WARM_WORDS` words. Only their numbers are sorted; their ids are read where they lie."""
    order = F.xxhash64("doc_id", "n_tokens", "n_known")
    chosen = train.select(order.alias("h"), "uid", "n_tokens").orderBy("h", "uid").limit(WARM).toPandas()
    within = chosen[(chosen["n_tokens"].cumsum() - chosen["n_tokens"]) < WARM_WORDS]
    uids = [int(u) for u in within["uid"]]
    return train.filter(F.col("uid").isin(uids)).select("ids").repartition(1)


def scores(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.
    The rank file is read on the driver and broadcast; it does not grow with the data."""
    with open(ranks_path, "rb") as f:
        lines = f.read()
    end = max(int(line.split()[1]) for line in lines.splitlines()) + 1
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = texts(docs, id_col, text_col).select(
        "doc_id", (digest % MODULUS == HELD_OUT).alias("held_out"), "text")
    counts = stored(word_counts(rows.filter("not held_out")), "words")
    ends = rows.filter("not held_out").count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    based_rows, rare = based(rows, counts, ends, lines, pattern, FREQUENT)
    train = based_rows.filter("not held_out")
    once_each = id_counts(train, end + 1)
    coding = Coding(once_each, id_counts(train, end + 1, leaders(once_each)))
    few = first_fit(train)
    weights = trained(few, coding, initial(), end, RATE)
    weights = trained(train, coding, weights, end, RATE / 4)
    model = docs.sparkSession.sparkContext.broadcast((coding, weights))

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coded, w = model.value
        for batch in batches:
            found = [score(w, coded, part, end) for part in portions(batch)]
            yield pd.Series(np.concatenate(found) / math.log(10))

    zero = F.lit(0)
    return (based_rows.select("*", scored("ids").alias("score")).drop("ids")
            .join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("log_sum") + F.coalesce("more_sum", F.lit(0.0))
         - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"), "score"))
