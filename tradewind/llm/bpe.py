"""Byte-level BPE: encode texts by a rank file, decode ids back to bytes.

A block's distinct pieces are laid out as one array of symbols with links to both
neighbours. An inverted index holds, for each rank, the positions whose symbol and
right neighbour concatenate to that token. Merges are then replayed in rank order
over all pieces at once; a merge re-ranks only the merged position and the one
before it. Within a piece equal ranks merge from the left, as the library does.

An empty or null text has no ids. Rows are independent: repeated rows and null ids
give the same row again. Memory is bounded by a block of texts plus its distinct
pieces; a single row is never cut.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import blocks, texts

NONE = np.iinfo(np.int64).max
BLOCK_CHARS = 2_000_000


class Vocabulary:
    """Ranks, and which neighbouring symbols make a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        tokens = sorted(ranks.items(), key=lambda x: x[1])
        self.length = np.zeros(tokens[-1][1] + 1, np.int64)
        self.start = np.zeros_like(self.length)
        at = 0
        for token, rank in tokens:
            self.length[rank], self.start[rank] = len(token), at
            at += len(token)
        self.flat = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)

    @classmethod
    def parse(cls, lines: bytes) -> Vocabulary:
        pairs = (line.split() for line in lines.splitlines() if line.strip())
        return cls({base64.b64decode(a): int(b) for a, b in pairs})

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        length = self.length[ids]
        shift = self.start[ids] - (np.cumsum(length) - length)
        return self.flat[np.repeat(shift, length) + np.arange(length.sum())].tobytes()


def distinct(at: np.ndarray) -> np.ndarray:
    """Sorted, without repeats (faster here than numpy.unique)."""
    at = np.sort(at)
    return at[np.append(True, at[1:] != at[:-1])] if len(at) else at


def replay(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces one after another, number of ids of each)."""
    size = np.array([len(p) for p in pieces], np.int64)
    n, ends = int(size.sum()), np.cumsum(size)
    symbol = np.append(vocab.single[np.frombuffer(b"".join(pieces), np.uint8)], 0)
    # Position n stands for "no neighbour".
    right, left = np.arange(1, n + 2), np.arange(-1, n)
    right[ends[size > 0] - 1] = n
    left[(ends - size)[size > 0]] = n
    alive = np.ones(n + 1, bool)
    rank = np.full(n + 1, NONE)
    index: defaultdict[int, list[np.ndarray]] = defaultdict(list)
    queue: list[int] = []

    def note(at: np.ndarray) -> None:
        """Rank these positions anew and enter them in the index."""
        new = np.where(right[at] < n, vocab.pair(symbol[at], symbol[right[at]]), NONE)
        rank[at] = new
        at, new = at[new != NONE], new[new != NONE]
        if not len(at):
            return
        order = np.argsort(new, kind="stable")
        at, new = at[order], new[order]
        cuts = np.flatnonzero(np.diff(new)) + 1
        for r, part in zip(new[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
            if r not in index:
                heapq.heappush(queue, r)
            index[r].append(part)

    note(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        at = np.concatenate(index.pop(r))
        at = distinct(at[rank[at] == r])  # entries of positions merged meanwhile are stale
        if not len(at):
            continue
        overlap = right[at[:-1]] == at[1:]
        if overlap.any():  # of overlapping pairs every second one merges, from the left
            i = np.arange(len(at))
            first = np.maximum.accumulate(np.where(np.append(True, ~overlap), i, 0))
            at = at[(i - first) % 2 == 0]
        gone = right[at]
        symbol[at], rank[gone], alive[gone] = r, NONE, False
        right[at] = right[gone]
        left[right[at]] = at
        before = left[at]
        note(distinct(np.concatenate([at, before[before < n]])))
    count = np.concatenate([[0], np.cumsum(alive[:n])])
    return symbol[:n][alive[:n]], count[ends] - count[ends - size]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start[0], start[0]+1, … of all ranges, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def piece_ids(pieces: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces one after another, number of ids of each)."""
    data = [p.encode("utf-8", "surrogatepass") for p in pieces]
    whole = np.array([vocab.ranks.get(p, -1) for p in data], np.int64)
    rest = np.flatnonzero(whole < 0)  # a piece that is a token needs no merge
    length = np.ones(len(data), np.int64)
    if len(rest):
        ids, length[rest] = replay([data[i] for i in rest], vocab)
    start = np.cumsum(length) - length
    flat = np.empty(int(length.sum()), np.int64)
    flat[start[whole >= 0]] = whole[whole >= 0]
    if len(rest):
        flat[spread(start[rest], length[rest])] = ids
    return flat, length


def numbering() -> defaultdict:
    """Gives each new key the next number."""
    code: defaultdict = defaultdict()
    code.default_factory = code.__len__
    return code


class Encoder:
    """Encodes blocks of texts and remembers the ids of at most `keep` cuts for the next.

    The pattern never matches across a space between two other characters, except that
    the space leads the match that follows. So a text is cut there, equal cuts are split
    by the pattern and merged once, and only texts with other spacing are split whole.
    """

    def __init__(self, vocab: Vocabulary, pattern: str, keep: int = 200_000):
        import regex

        self.vocab, self.split, self.keep = vocab, regex.compile(pattern).findall, keep
        self.forget()

    def forget(self) -> None:
        self.cut_of = numbering()
        self.plain = np.empty(0, bool)
        self.ids = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)

    def merge(self, found: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of pieces, `counts` pieces each, and the number of ids of each."""
        piece_of = numbering()
        pieces = np.fromiter(map(piece_of.__getitem__, found), np.int64, len(found))
        ids, size = piece_ids(list(piece_of), self.vocab)
        start = np.cumsum(size) - size
        ids = ids[spread(start[pieces], size[pieces])].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(size[pieces])])[np.cumsum(counts, dtype=np.int64)]
        return ids, np.diff(ends, prepend=0)

    def learn(self) -> None:
        """Encode the cuts numbered since the last block."""
        found: list[str] = []
        counts, plain = [], []
        for key in islice(self.cut_of, len(self.plain), None):
            cut, before = key[0] if type(key) is tuple else key, len(found)
            plain.append(bool(cut) and not cut[0].isspace() and not cut[-1].isspace())
            if plain[-1]:
                found += self.split(cut if type(key) is tuple else " " + cut)
            counts.append(len(found) - before)
        if counts:
            ids, size = self.merge(found, counts)
            self.start = np.append(self.start, len(self.ids) + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.ids = np.append(self.ids, ids)
            self.plain = np.append(self.plain, plain)

    def __call__(self, values: list[str]) -> list[np.ndarray]:
        if len(self.cut_of) > self.keep:
            self.forget()
        coded = []
        for text in values:
            first, *others = text.split(" ")
            coded.append(np.fromiter(map(self.cut_of.__getitem__, [(first,), *others]), np.int32))
        self.learn()
        out = [self.ids[spread(self.start[c], self.size[c])] if self.plain[c].all() else None
               for c in coded]
        whole = [i for i, x in enumerate(out) if x is None]
        if whole:
            split = [self.split(values[i]) for i in whole]
            ids, size = self.merge([p for s in split for p in s], [len(s) for s in split])
            for i, part in zip(whole, np.split(ids, np.cumsum(size)[:-1]), strict=True):
                out[i] = part
        return out


_parsed: dict[int, Vocabulary] = {}


def vocabulary(lines: bytes) -> Vocabulary:
    """One parsed vocabulary per Python worker."""
    key = hash(lines)
    if key not in _parsed:
        _parsed.clear()
        _parsed[key] = Vocabulary.parse(lines)
    return _parsed[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) for every row and, if asked for, `decoded binary`, what the
    ids stand for. The rank file is read on the driver and broadcast: a vocabulary is a
    fixed file that does not grow with the data."""
    with open(ranks_path, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The cuts are remembered for one task: workers live on and serve other operators.
        encoded = Encoder(vocabulary(lines.value), pattern)
        for block in blocks(batches, chars=BLOCK_CHARS):
            ids = encoded(block["text"].tolist())
            out = pd.DataFrame({"doc_id": block["doc_id"].array, "ids": ids})
            if decoded:
                out["decoded"] = [encoded.vocab.decode(x) for x in ids]
            yield out

    # As text, since pandas would turn ids beside a null into floats.
    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.mapInPandas(
        run, "doc_id string, ids array<int>" + ", decoded binary" * decoded).withColumn(
            "doc_id", F.col("doc_id").cast("long"))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """The columns of `encoded` and `decoded binary`; null ids give empty bytes."""
    with open(ranks_path, "rb") as f:
        lines = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf(T.BinaryType())
    def bytes_of(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(lines.value)
        for part in ids:
            yield part.map(lambda x: b"" if x is None else vocab.decode(x))

    return encoded.select("*", bytes_of(F.col(ids_col)).alias("decoded"))


def digests(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids."""
    both = encode(docs, ranks_path, pattern, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), *["ids"] * with_ids)
