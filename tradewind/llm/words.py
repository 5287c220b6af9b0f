"""64-bit hashes of words and of runs of words, computed for whole texts at once."""

from __future__ import annotations

import numpy as np

KNOWN = 200_000  # remembered words of a worker
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Known(dict):
    digest = None

    def __missing__(self, word):
        self[word] = out = self.digest(word)
        return out


_known = Known()


def hashes(words: list) -> np.ndarray:
    """XXH3 of each word; a worker hashes a word it remembers only once."""
    import xxhash

    if len(_known) > KNOWN:
        _known.clear()
    _known.digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def forget() -> None:
    """At the end of a task: workers live on and serve other operators."""
    _known.clear()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` words; empty if there are fewer."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * FACTOR + word_hashes[i:i + n]
    return mixed(out)
