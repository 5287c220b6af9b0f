"""A small causal self-attention model in numpy, over classes of subword ids.

log P(id) = log P(class | context) + log P(id | class). The class comes from one layer of
masked self-attention over the embeddings of the ids before, the second part from counts.
"""

from __future__ import annotations

import numpy as np

WIDTH, STRIDE = 16, 12  # of a context window; how far the next one moves
DIM, CLASSES, INPUTS = 16, 64, 2048
LEADERS, BACKOFF = 64, 50.0
SHAPES = {"embed": (INPUTS, DIM), "place": (WIDTH, DIM), "qkv": (DIM, 3 * DIM),
          "out": (DIM, DIM), "head": (DIM + 1, CLASSES)}  # the last row of head is a bias
SEEN = np.tril(np.ones((WIDTH, WIDTH), np.float32))
LARGEST = np.float32(40)  # of a logit, so that exp() stays finite without shifting by the maximum


def initial(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: (rng.standard_normal(s) * 0.2).astype(np.float32)
            for k, s in SHAPES.items()}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = values[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def grouped(features: np.ndarray, groups: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spread rows."""
    centers = features[np.linspace(0, len(features) - 1, groups).astype(int)].copy()
    for _ in range(rounds):
        own = (features @ centers.T - (centers ** 2).sum(axis=1) / 2).argmax(axis=1)
        for g in np.unique(own):
            centers[g] = features[own == g].mean(axis=0)
    return own


def leaders(counts: np.ndarray) -> np.ndarray:
    """For each id its rank among the `LEADERS` most frequent, else `LEADERS`."""
    order = np.lexsort((np.arange(len(counts)), -counts))[:LEADERS]
    out = np.full(len(counts), LEADERS, np.int64)
    out[order] = np.arange(len(order))
    return out


class Coding:
    """What ids become: an input row, a class, and a probability within the class.

    counts: of each id. pairs: of each id after each of the leading ids or any other
    (LEADERS + 1 rows). The most frequent ids have a class of their own; the rest is
    grouped by what it follows. Within a class an id's probability depends on the leading
    id before it, and falls back on the class's counts.
    """

    def __init__(self, counts: np.ndarray, pairs: np.ndarray):
        n, alone = len(counts), CLASSES // 2
        order = np.lexsort((np.arange(n), -counts))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        self.leader = leaders(counts)
        self.to_class = np.empty(n, np.int32)
        self.to_class[order[:alone]] = np.arange(len(order[:alone]))
        rest = order[alone:]
        profile = np.sqrt((pairs[:, rest].T + 0.1) / (pairs[:, rest].sum(axis=0) + 0.1 * len(pairs))[:, None])
        self.to_class[rest] = alone + grouped(profile, CLASSES - alone)
        shared = INPUTS // 8
        self.to_input = np.where(rank < INPUTS - shared, rank, INPUTS - shared + rank % shared)
        mass = np.bincount(self.to_class, weights=counts + 1.0, minlength=CLASSES)
        plain = (counts + 1.0) / mass[self.to_class]
        self.within = np.empty(pairs.shape, np.float32)
        for i, row in enumerate(pairs):
            of_class = np.bincount(self.to_class, weights=row, minlength=CLASSES)
            self.within[i] = np.log((row + BACKOFF * plain) / (of_class[self.to_class] + BACKOFF))


def windows(texts: list[np.ndarray], end: int, stride: int) -> tuple[np.ndarray, ...]:
    """(inputs, targets, first place to score, text number) of overlapping windows: each
    text is `end` + ids, to be continued by ids + `end`; every target is scored in exactly
    one window. Padding has target -1."""
    ins, outs, first, owner = [], [], [], []
    for number, ids in enumerate(texts):
        n = len(ids) + 1
        count = 1 + max(0, -(-(n - WIDTH) // stride))
        line = np.full((count - 1) * stride + WIDTH + 1, -1, np.int64)
        line[0] = end
        line[1:n] = ids
        line[n] = end
        at = np.arange(count)[:, None] * stride + np.arange(WIDTH)
        goal = line[at + 1]
        goal[at + 1 > n] = -1
        ins.append(np.where(line[at] < 0, end, line[at]))
        outs.append(goal)
        first.append(np.where(np.arange(count) == 0, 0, WIDTH - stride))
        owner.append(np.full(count, number))
    return tuple(map(np.concatenate, (ins, outs, first, owner)))


def forward(w: dict[str, np.ndarray], rows: np.ndarray):
    """(x, q, k, v, exp of scores, their sums, mixed values, hidden state and a 1)."""
    x = w["embed"][rows]
    x += w["place"]
    qkv = (x.reshape(-1, DIM) @ w["qkv"]).reshape(*rows.shape, 3 * DIM)
    q, k, v = qkv[..., :DIM] * np.float32(DIM ** -0.5), qkv[..., DIM:2 * DIM], qkv[..., 2 * DIM:]
    a = np.matmul(q, k.transpose(0, 2, 1))
    np.minimum(a, LARGEST, out=a)
    np.exp(a, out=a)
    a *= SEEN
    total = a.sum(axis=2, keepdims=True)
    o = np.matmul(a, v)
    o /= total
    h = np.ones((*rows.shape, DIM + 1), x.dtype)
    np.add(x, (o.reshape(-1, DIM) @ w["out"]).reshape(x.shape), out=h[..., :DIM])
    return x, q, k, v, a, total, o, h


def class_odds(w: dict[str, np.ndarray], h: np.ndarray, over: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(logits, exp of them); `over`: the exp is written over the logits."""
    z = h @ w["head"]
    np.minimum(z, LARGEST, out=z)
    return z, np.exp(z, out=z if over else None)


def score(w: dict[str, np.ndarray], coding: Coding, texts: list[np.ndarray], end: int,
          batch: int = 256) -> np.ndarray:
    """Natural log probability of each text and its end."""
    ins, outs, first, owner = windows(texts, end, STRIDE)
    total = np.zeros(len(texts))
    for i in range(0, len(ins), batch):
        part = slice(i, i + batch)
        h = forward(w, coding.to_input[ins[part]])[-1]
        goal = outs[part]
        live = (goal >= 0) & (np.arange(WIDTH) >= first[part][:, None])
        goal = goal[live]
        z, odds = class_odds(w, h[live])
        value = (z[np.arange(len(goal)), coding.to_class[goal]] - np.log(odds.sum(axis=1))
                 + coding.within[coding.leader[ins[part][live]], goal])
        total += np.bincount(owner[part][np.nonzero(live)[0]], weights=value, minlength=len(texts))
    return total


def gradient(w: dict[str, np.ndarray], rows: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy of `goal` (classes, -1: not scored)."""
    x, q, k, v, a, total, o, h = forward(w, rows)
    a /= total
    live = goal >= 0
    every = bool(live.all())  # most batches have no padding
    seen = h.reshape(-1, DIM + 1) if every else h[live]
    dz = class_odds(w, seen, over=True)[1]
    dz /= dz.sum(axis=1, keepdims=True)
    dz[np.arange(len(dz)), goal[live]] -= 1
    dz /= max(1, len(dz))
    dh = np.zeros_like(x)
    dh[slice(None) if every else live] = (dz @ w["head"][:DIM].T).reshape(x.shape if every else (-1, DIM))
    flat_dh = dh.reshape(-1, DIM)
    do = (flat_dh @ w["out"].T).reshape(o.shape)
    ds = np.matmul(do, v.transpose(0, 2, 1))
    ds -= (do * o).sum(axis=2, keepdims=True)
    ds *= a
    dqkv = np.concatenate([np.matmul(ds, k) * np.float32(DIM ** -0.5),
                           np.matmul(ds.transpose(0, 2, 1), q),
                           np.matmul(a.transpose(0, 2, 1), do)], axis=2).reshape(-1, 3 * DIM)
    dx = dh + (dqkv @ w["qkv"].T).reshape(x.shape)
    at = rows.ravel()
    order = np.argsort(at.astype(np.int16), kind="stable")  # INPUTS < 2^15: sorted by digits
    starts = np.flatnonzero(np.diff(at[order], prepend=-1))
    embed = np.zeros_like(w["embed"])
    embed[at[order][starts]] = np.add.reduceat(dx.reshape(-1, DIM)[order], starts, axis=0)
    return {"embed": embed, "place": dx.sum(axis=0), "qkv": x.reshape(-1, DIM).T @ dqkv,
            "out": o.reshape(-1, DIM).T @ flat_dh, "head": seen.T @ dz}


class Trainer:
    """Adam over batches of windows that do not overlap."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.w = {k: v.copy() for k, v in weights.items()}
        self.rate, self.steps, self.tokens = rate, 0, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.s = {k: np.zeros_like(v) for k, v in weights.items()}

    def learn(self, coding: Coding, texts: list[np.ndarray], end: int, batch: int = 256) -> None:
        ins, outs, _, _ = windows(texts, end, WIDTH)
        for i in range(0, len(ins), batch):
            goal = outs[i:i + batch]
            classes = np.where(goal >= 0, coding.to_class[goal], -1)
            self.step(gradient(self.w, coding.to_input[ins[i:i + batch]], classes))
            self.tokens += int((goal >= 0).sum())

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        fix = np.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.s[k] += 0.001 * (d * d - self.s[k])
            self.w[k] -= (self.rate * fix) * self.m[k] / (np.sqrt(self.s[k]) + 1e-8)
