"""Language identification with mixtures: which languages a text holds, and in what shares.

Training counts the trigrams of lower-cased words (edges included, hashed into `BUCKETS`) of
every labelled document, by language. A language's trigram distribution is its relative
frequency mixed with the one of all languages (`SHARED`), which gives an unseen trigram the
same likelihood everywhere.

A word's likelihood under a language is the product over its trigrams. A document is a
mixture: each word comes from one language, and expectation-maximisation estimates the
languages' proportions. It starts from all languages and drops the one with the least
proportion, round after round; of the sets met on the way, and the best single language, the one with the
greatest likelihood less half the log of the number of words per language beyond the first
is chosen. Rounds end early where no smaller set can matter: if the likelihood of the best
single language is within the penalty of the mixture's, one language it is.

Prediction uses the text alone. lang_pred is the language with the greatest proportion in
the chosen set (ties: the first by name), score that proportion, `languages` the set.

Memory: two integers of trigrams a character in blocks of `BLOCK` characters, then one number
a word and language. Broadcast: `BUCKETS` numbers a language; more than `MOST_LANGUAGES`
distinct labels are an error.

A null text or one without a letter is `und`, score 0, and so is every text if nothing is
labelled. A null lang or doc_id is no training example (a null id cannot be dealt to a
fold, and counts as not held out). Rows are independent, so repeated rows give the same result again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import blocks, texts

BUCKETS, SHARED = 1 << 15, 0.05
BLOCK, STEPS, CLOSE = 1_000_000, 12, 1e-3
MOST_LANGUAGES = 400
FOLDS, HELD_OUT = 5, 0
NONE = "und"


@cache
def letters() -> np.ndarray:
    """Is a code point a letter? Other characters part words."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram, first trigram of each word, first word of each text and the end)."""
    low = [p.lower() for p in parts]
    points = np.frombuffer("\0".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = letters()[points]
    points = np.where(inside, points, np.uint32(0))
    edge = np.flatnonzero(inside[1:] | inside[:-1]) + 1  # letters, and the place after each word
    one = points[edge].astype(np.uint64)
    two = points[edge - 1].astype(np.uint64)
    three = np.where((two > 0) & (edge > 1), points[np.maximum(edge - 2, 0)], np.uint32(0)).astype(np.uint64)
    key = (one << np.uint64(42)) ^ (two << np.uint64(21)) ^ three
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    grams = (key >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
    first = np.flatnonzero(inside[edge] & ~inside[edge - 1])
    ends = np.cumsum([1] + [len(p) + 1 for p in low])
    return grams, first, np.searchsorted(edge[first], ends)


def counted(docs: DataFrame) -> DataFrame:
    """(lang, n, counts): trigram counts of docs(text, lang), 64-bit numbers in one value."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def out() -> pd.DataFrame:
            found = [(lang, b, c[b]) for lang, c in held.items() for b in [np.flatnonzero(c)]]
            return pd.DataFrame({"lang": np.repeat([x[0] for x in found], [len(x[1]) for x in found]),
                                 "bucket": np.concatenate([x[1] for x in found]),
                                 "n": np.concatenate([x[2] for x in found])})

        for block in blocks(batches, chars=BLOCK):
            for lang, group in block.groupby("lang"):
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang] += np.bincount(trigrams(group["text"].tolist())[0], minlength=BUCKETS)
            if len(held) > 64:
                yield out()
                held.clear()
        if held:
            yield out()

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(BUCKETS, np.int64)
        counts[rows["bucket"]] = rows["n"]
        return pd.DataFrame({"lang": [key[0]], "counts": [counts.tobytes()]})

    parts = docs.select("text", "lang").mapInPandas(run, "lang string, bucket int, n long")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))  # at most BUCKETS rows a language
    return sums.groupBy("lang").applyInPandas(packed, "lang string, counts binary")


class Model:
    """Log-likelihoods [language, bucket] and the languages' names, ascending."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.names = sorted(counts)
        table = np.array([counts[name] for name in self.names], np.float64).reshape(-1, BUCKETS)
        shared = (table.sum(axis=0) + 1) / (table.sum() + BUCKETS)
        own = table / np.maximum(table.sum(axis=1, keepdims=True), 1)
        self.logs = np.log((1 - SHARED) * own + SHARED * shared).astype(np.float32)

    def word_logs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """([language, word], first word of each text and the end)."""
        grams, first, ends = trigrams(texts)
        if not len(first) or not self.names:
            return np.zeros((len(self.names), 0)), ends
        return np.array([np.add.reduceat(row[grams], first) for row in self.logs], np.float64).reshape(
            len(self.names), -1), ends


def mixed(logs: np.ndarray, size: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for many texts at once, none empty: (proportions [language,
    text], log-likelihoods). `size` words [language, word] belong to each text; only allowed
    languages take part. A text stops by its own steps, whatever the others do."""
    owner = np.repeat(np.arange(len(size)), size)
    masked = np.where(allowed[:, owner], logs, -np.inf)
    top = masked.max(axis=0)
    likely = np.exp(masked - top)
    final = allowed / allowed.sum(axis=0)
    here = np.arange(len(size))  # the texts still in work
    share, part, own, sizes = final.copy(), likely, owner, size
    for _ in range(STEPS):
        joint = part * share[:, own]
        joint /= joint.sum(axis=0)
        new = np.add.reduceat(joint, np.cumsum(sizes) - sizes, axis=1) / sizes
        final[:, here] = new
        still = np.abs(new - share).max(axis=0) >= CLOSE
        if not still.any():
            break
        here, share = here[still], new[:, still]
        words = np.repeat(still, sizes)
        part, sizes = part[:, words], sizes[still]
        own = np.repeat(np.arange(len(sizes)), sizes)
    total = np.log((likely * final[:, owner]).sum(axis=0)) + top
    return final, np.add.reduceat(total, np.cumsum(size) - size)


def pick(texts: list[str], model: Model) -> list[np.ndarray | None]:
    """The proportions of the chosen languages of each text; None where no letter is."""
    logs, ends = model.word_logs(texts)
    out: list[np.ndarray | None] = [None] * len(texts)
    at = np.flatnonzero(np.diff(ends))
    if not len(at) or not model.names:
        return out
    size, starts = np.diff(ends)[at], ends[at]  # texts without words take no room
    penalty = np.log(size) / 2
    single = np.add.reduceat(logs, starts, axis=1)
    best = single.max(axis=0)
    chosen = np.zeros((len(model.names), len(at)))
    chosen[single.argmax(axis=0), np.arange(len(at))] = 1
    allowed = np.ones(chosen.shape, bool)
    limit = np.add.reduceat(logs.max(axis=0), starts)  # what no mixture exceeds
    todo = np.arange(len(at))
    while len(todo := todo[(allowed[:, todo].sum(axis=0) > 1) & (limit[todo] - penalty[todo] > best[todo])]):
        here = np.zeros(len(at), bool)
        here[todo] = True
        share, value = mixed(logs[:, np.repeat(here, size)], size[todo], allowed[:, todo])
        kept = share > CLOSE
        limit[todo] = value
        score = value - penalty[todo] * (kept.sum(axis=0) - 1)
        better = score > best[todo]
        chosen[:, todo[better]] = (share * kept)[:, better]
        best[todo[better]] = score[better]
        least = np.where(kept, share, np.inf).argmin(axis=0)
        kept[least, np.arange(len(todo))] = False
        allowed[:, todo] = kept
    chosen /= chosen.sum(axis=0)
    for place, i in enumerate(at.tolist()):
        out[i] = chosen[:, place]
    return out


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """The languages of all rows of `docs` with a label."""
    rows = docs.filter(F.col(lang_col).isNotNull()).select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    found = counted(rows).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return Model({r["lang"]: np.frombuffer(r["counts"], np.int64) for r in found})


def predicted(rows: DataFrame, text: Column, model: Model) -> Column:
    """Struct (lang_pred, score, languages) of a text column."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, languages string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = shared.value.names
        chars = max(1, BLOCK * 4 // max(len(names), 4))
        for batch in batches:
            found = [f for part in blocks([batch.to_frame("text")], chars=chars)
                     for f in pick(part["text"].tolist(), shared.value)]
            yield pd.DataFrame([(NONE, 0.0, "") if f is None else (
                names[int(f.argmax())], min(1.0, float(f.max())),
                ",".join(f"{names[i]}:{f[i]:.3f}" for i in np.flatnonzero(f))) for f in found],
                columns=["lang_pred", "score", "languages"])

    return judge(text)


def held_out(ident: Column) -> Column:
    """The fold rule: crc32 of the id as text; a null id is in no fold."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages of every document."""
    model = fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    rows = texts(docs)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       predicted(rows, F.col("text"), model).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score", "found.languages")
