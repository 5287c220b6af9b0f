"""Keys that occur more than once, without shuffling keys that do not.

Pass one turns every key into a position in a bit array of `SPARE` bits a row. A task sends
its positions sorted and as gaps (about two bytes a row instead of the key), one piece a
range of positions, and the task of a range keeps those that occur twice. Pass two groups
only the rows at such positions: equal keys share a position, so none is missed, and
different keys that do are told apart by the grouping. With unique keys that is one row in
`SPARE`.

Tables under `SMALL` rows are grouped at once, and so is a table of which more positions repeat
than may be broadcast (`MOST` of them): then most of the keys have to meet anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import settled

SMALL, MOST = 100_000, 2_000_000
SPARE = 1 << 12  # positions a row, so that one unique key in 4,096 meets another
RANGE_ROWS = 4_000_000  # rows whose positions meet in one task


def packed(sorted_positions: np.ndarray) -> bytes:
    """Ascending numbers as variable-length gaps: 15 bits, or a marked 64-bit number."""
    gaps = np.diff(sorted_positions, prepend=np.uint64(0))
    small = gaps < 0xFFFF
    out = np.where(small, gaps, 0xFFFF).astype(np.uint16)
    return len(out).to_bytes(8, "little") + out.tobytes() + gaps[~small].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    out = np.frombuffer(data, np.uint16, n, 8).astype(np.uint64)
    wide = out == 0xFFFF
    out[wide] = np.frombuffer(data, np.uint64, int(wide.sum()), 8 + 2 * n)
    return np.cumsum(out)


def _positions(columns: list[str], bits: int):
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


def repeated_positions(rows: DataFrame, columns: list[str], n: int) -> DataFrame:
    """(at) of all positions that occur at least twice among rows without a NULL key."""
    bits = min(62, max(16, (n * SPARE - 1).bit_length()))
    ranges = 1 << max(0, (n // RANGE_ROWS).bit_length())
    shift = np.uint64(bits - ranges.bit_length() + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def out() -> pd.DataFrame:
            found = np.sort(np.concatenate(held))
            part = (found >> shift).astype(np.int64)
            numbers, first = np.unique(part, return_index=True)
            pieces = [packed(p) for p in np.split(found, first[1:])]
            return pd.DataFrame({"part": numbers, "data": pieces})

        for batch in batches:
            held.append(batch["at"].to_numpy(np.uint64))
            size += len(batch)
            if size > RANGE_ROWS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def meet(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = np.sort(np.concatenate([unpacked(d) for d in part["data"]]))
        again = found[1:][found[1:] == found[:-1]]
        return pd.DataFrame({"at": np.unique(again).astype(np.int64)})

    pieces = rows.select(_positions(columns, bits).alias("at")).mapInPandas(run, "part long, data binary")
    return pieces.groupBy("part").applyInPandas(meet, "at long")


def repeated(df: DataFrame, columns: list[str], small: int = SMALL, most: int = MOST) -> DataFrame:
    """(columns, count) of the keys without a NULL part that occur at least twice."""
    rows = df.select(*columns).dropna(how="any")
    n = df.count()
    if n >= small:
        again = settled(repeated_positions(rows, columns, n), "repeated-positions")
        if again.count() <= most:
            bits = min(62, max(16, (n * SPARE - 1).bit_length()))
            rows = rows.join(F.broadcast(again), _positions(columns, bits) == again["at"], "left_semi")
    return rows.groupBy(*columns).count().filter("count > 1")
