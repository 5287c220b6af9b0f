"""SimHash near-duplicates, compared on bit planes.

A text's fingerprint has a bit set where over half of its 3-word shingles' hashes have
it. Distinct fingerprints within `RADIUS` differing bits agree on two of five blocks of
bits, so every pair meets in one of ten buckets. Inside sorted buckets row i is compared
with row i + shift for all lanes of a batch at once: bit 0 of all rows lies in one row of
machine words, bit 1 in the next, and so on. Carry-save counters add up the differing
bits of 64 pairs per word; words whose pairs all exceed the radius are abandoned.

Equal fingerprints are one node, so copies of any number cost nothing. A bucket beyond
`LARGE` is split on more bits, and what still is too large is dealt out as pairs of
tiles; both are exact. A batch reports at most a spanning forest of its links.

Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows and
null ids stay, one result row each; a component without any id has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.components import components
from tradewind.llm.frames import stored, texts

RADIUS, LARGE = 3, 4096
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
BITS = np.uint64(64)


def mask(low: int, width: int) -> int:
    return ((1 << width) - 1) << low


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


BLOCKS = [mask(13 * i, 13) for i in range(4)] + [mask(52, 12)]
TABLES = [BLOCKS[i] | BLOCKS[j] for i in range(5) for j in range(i)]


def finer(table: int) -> list[int]:
    """Four parts of the bits that `table` leaves free: three differing bits leave one of
    them equal, so pairs within a bucket meet again in a finer one."""
    free = [b for b in range(64) if not table >> b & 1]
    return [table | sum(1 << b for b in free[i::4]) for i in range(4)]


def fingerprint(text: str) -> int:
    """64 bits, as a signed number."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size, line = min(3, len(words)), b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in
                       zip(starts.tolist(), ends[size - 1:].tolist(), strict=False)], np.uint64)
    by_byte = np.bincount((hashes.view(np.uint8).reshape(-1, 8)
                           + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
    bits = (by_byte @ BYTE_BITS).ravel() * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(text: pd.Series) -> pd.Series:
    return text.map(fingerprint).astype("int64")


def planes(values: np.ndarray) -> np.ndarray:
    """Row b holds bit b of all values, 64 values a word, with a spare word at the end."""
    bits = np.zeros((64, -(-len(values) // 64) * 64 + 64), np.uint8)
    bits[:, : len(values)] = np.unpackbits(
        values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def packed(flags: np.ndarray, words: int) -> np.ndarray:
    wide = np.zeros(words * 64, bool)
    wide[: len(flags)] = flags
    return np.packbits(wide, bitorder="little").view(np.uint64)


def moved(plane: np.ndarray, shift: int) -> np.ndarray:
    """The planes of the values `shift` rows further on."""
    word, bit = divmod(shift, 64)
    out = np.zeros_like(plane)
    out[:, : plane.shape[1] - word] = plane[:, word:]
    if bit:
        bit = np.uint64(bit)
        out >>= bit
        out[:, : plane.shape[1] - word - 1] |= plane[:, word + 1:] << (BITS - bit)
    return out


def near_lanes(plane: np.ndarray, shift: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Rows i, among valid lanes, that differ from row i + shift in at most radius bits."""
    at = np.flatnonzero(valid)
    live = valid[at]
    a, b = plane[:, at], moved(plane, shift)[:, at]
    ones, twos = np.zeros_like(live), np.zeros_like(live)
    for low in range(0, 64, 8):
        for bit in range(low, low + 8):
            carry = a[bit] ^ b[bit]
            ones, carry = ones ^ carry, ones & carry
            twos, carry = twos ^ carry, twos & carry
            live &= ~carry  # a fourth differing bit
        keep = np.flatnonzero(live)
        if len(keep) < len(live):  # abandon the words in which no lane is left
            at, live, ones, twos = at[keep], live[keep], ones[keep], twos[keep]
            a, b = a[:, keep], b[:, keep]
        if not len(at):
            break
    for value in range(radius + 1, 4):
        live &= ~((ones if value & 1 else ~ones) & (twos if value & 2 else ~twos))
    lanes = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(lanes.reshape(-1, 64)) if len(at) else (np.empty(0, int),) * 2
    return at[word] * 64 + bit


def near_pairs(bucket: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> list[tuple]:
    """A spanning forest of the links of fingerprints in equal buckets (sorted)."""
    n = len(values)
    size = np.bincount(bucket)[bucket]
    root, pairs = np.arange(n), []
    rows, plane, shift = np.arange(n), None, 1
    while True:
        left = rows[size[rows] > shift]
        if len(left) < 2:
            return pairs
        if plane is None or len(left) <= len(rows) // 2:
            rows, plane = left, planes(values[left])
        same = bucket[rows[:-shift]] == bucket[rows[shift:]]
        for i in near_lanes(plane, shift, packed(same, plane.shape[1]), radius):
            a, b = rows[i], rows[i + shift]
            while root[a] != a:
                root[a] = a = root[root[a]]
            while root[b] != b:
                root[b] = b = root[root[b]]
            if a != b:
                root[max(a, b)] = min(a, b)
                pairs.append((int(values[rows[i]]), int(values[rows[i + shift]])))
        shift += 1


def _compare(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by key; a bucket that the batch cuts waits for the next one."""
    rest = None

    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = frame.groupby(["t", "k", "tile"], sort=False).ngroup().to_numpy()
        found = near_pairs(bucket, frame["fp"].to_numpy(np.int64), radius)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(frame):
            continue
        key = frame[["t", "k", "tile"]]
        last = (key == key.iloc[-1]).all(axis=1).to_numpy()
        rest, frame = frame[last], frame[~last]
        if len(frame):
            yield pairs(frame)
    if rest is not None and len(rest):
        yield pairs(rest)


def _keyed(prints: DataFrame, tables: list[int], from_table: Column | None = None) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k"))
                     for i, m in enumerate(tables)])
    if from_table is not None:  # only the four finer tables of the row's own
        keys = F.slice(keys, from_table * 4 + 1, 4)
    return prints.select("fp", F.explode(keys).alias("x")).select("fp", "x.t", "x.k")


def links(prints: DataFrame, radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """(a, b): links that connect whatever fingerprints of `prints(fp)`, all distinct, lie
    within `radius` (at most 3) bits, directly or over others."""
    def sizes(keyed: DataFrame) -> DataFrame:
        return keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter(F.col("n") > large)

    keyed = _keyed(prints, TABLES).withColumn("tile", F.lit("0"))
    hot = stored(sizes(keyed), "hot")
    if not hot.isEmpty():
        fine = _keyed(keyed.join(hot, ["t", "k"]).select("fp", "t"),
                      [m for table in TABLES for m in finer(table)], F.col("t"))
        fine = stored(fine.withColumn("t", F.col("t") + len(TABLES)), "fine")
        n = stored(sizes(fine), "n")
        # Beyond that: every row goes to each pair of tiles that holds its own.
        own = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
        tiles = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda other: F.concat_ws(
            "-", F.least(own, other).cast("string"), F.greatest(own, other).cast("string")))
        dealt = (fine.join(n, ["t", "k"], "left")
                 .withColumn("g", F.ceil(F.coalesce("n", F.lit(1)) / large).cast("int"))
                 .select("fp", "t", "k", F.explode(tiles).alias("tile")))
        keyed = keyed.join(hot, ["t", "k"], "left_anti").unionByName(dealt)
    return (keyed.repartition("t", "k", "tile").sortWithinPartitions("t", "k", "tile", "fp")
            .mapInPandas(lambda batches: _compare(batches, radius), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row. root names the component
    by its least fingerprint; component_id is the smallest id in it."""
    prints = stored(texts(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), fingerprints("text").alias("fp")),
        "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp")))
    rooted = stored(nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = stored(rooted.join(least, "root").select("fp", "root", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without near-duplicates: of each component the row with the smallest id
    stays (null ids come last, equal ids go by the hash of their texts)."""
    def key(number: Column, text_hash: Column) -> list[Column]:
        return [number.isNull().alias("no_id"), F.coalesce(number, F.lit(0)).alias("id"),
                text_hash.alias("hash")]

    groups = near_duplicates(docs, id_col, text_col)
    kept = stored(groups.groupBy("root").agg(F.min(F.struct(*key(
        F.col("doc_id"), F.col("text_hash")))).alias("x")).select("x.*"), "kept")
    text_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), *key(F.col(id_col).cast("long"), text_hash))
    # `kept` grows with the documents: a merge join at every size, whose order of the rows
    # then serves to drop repeated ones.
    names = ["no_id", "id", "hash"]
    found = rows.join(kept.hint("merge"), names, "left_semi")
    return found.dropDuplicates(names).select("row.*")
