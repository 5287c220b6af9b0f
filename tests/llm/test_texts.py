"""Quality rules, BPE, decontamination and language-model scores against brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import public_tokenizers as vocabularies
import pytest

from tradewind.llm import attention, bpe, decontaminate, lm, quality

RANKS = vocabularies.path("byte_bpe_50k.tiktoken")
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(library):
    rng = random.Random(1)
    chars = [chr(c) for c in (*range(0x250), 0x2028, 0x85, 0xA0, 0x3000, 0x301, 0x4E00, 0x1F600)]
    texts = ["".join(rng.choices(chars + list("ab  \n1") * 60, k=rng.randint(0, 150))) for _ in range(600)]
    texts += ["", "a" * 999, "ab" * 3000, " " * 700, "aaab" * 90, "the cat 's  sat\n\n on", cases.LONG]
    with open(RANKS, "rb") as f:
        vocab = bpe.vocabulary(f.read())
    encoder = bpe.Encoder(vocab, vocabularies.PATTERN, keep=500)
    for _ in range(2):  # the second time from remembered cuts
        for text, ids in zip(texts, encoder(texts), strict=True):
            assert ids.tolist() == library.encode_ordinary(text)
            assert vocab.decode(ids) == text.encode()


def test_bpe_rows(spark, library):
    df = cases.frame(spark)
    got = Counter(map(tuple, bpe.digests(df, RANKS, vocabularies.PATTERN).collect()))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for row in cases.rows():
        ids = library.encode_ordinary(row[1] or "")
        want[row[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((row[1] or "").encode())] += 1
    assert got == want
    back = bpe.decode(bpe.encode(df, RANKS, vocabularies.PATTERN), RANKS)
    assert sorted(bytes(r["decoded"]).decode() for r in back.collect()) == sorted(
        r[1] or "" for r in cases.rows())
    assert bpe.digests(df.limit(0), RANKS, vocabularies.PATTERN).count() == 0


def base_counts(text):
    words = re.findall(SPACE, text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        hit |= set(range(i, i + 5)) if count[w] > 1 else set()
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


def test_quality_base():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choices(["a", "b", "é", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", "#", "|", "a b c d e "],
                                   k=rng.randint(0, 60)))
        assert quality.base_counts(text) == base_counts(text), text


def test_quality_judges(spark):
    rng = random.Random(9)
    docs = [(i, cases.prose(rng, 40)) for i in range(80)]
    docs += [(100 + i, " ".join(f"zz{rng.randrange(900)}!!" for _ in range(40))) for i in range(40)]
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(30)]
    cases.frame(spark)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.report(df, marks).collect() if r["kept"]}
    assert kept == set(range(80))
    assert {r["doc_id"] for r in quality.keep(df, marks).collect()} == kept
    for few in (marks.limit(0), marks.filter("quality = 1")):  # no labels of one kind: the base rule alone
        assert quality.report(df, few).filter("kept").count() == 120


def test_quality_odd_documents(spark):
    df = cases.frame(spark)
    marks = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, None), (None, 1, 0), (50, 0, None)],
                                  "doc_id long, quality int, toxic int")
    rows = quality.report(df, marks).collect()
    assert cases.ids(rows) == cases.all_ids()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (30, 31, 32, 51))
    assert quality.keep(df, marks).columns == df.columns
    assert quality.report(df.limit(0), marks).count() == 0


def test_decontaminate(spark):
    rng = random.Random(2)
    item = lambda n: cases.prose(rng, n)
    items = [(1, item(30)), (2, item(14)), (3, "only three words"), (4, None), (5, ""), (None, item(20)),
             (7, item(40))]
    cut = " ".join(items[6][1].split()[:20]) + " x " + item(500) + " " + " ".join(items[6][1].split()[20:])
    docs = [(1, item(400) + " " + items[0][1].upper() + " " + item(300)), (2, item(2000)), (3, None),
            (4, "so Only, three WORDS here"), (5, "a " + items[5][1]), (6, cut), (6, cut), (8, items[1][1][:-20])]
    schema = "doc_id long, text string, item_id long, hits string"
    df = spark.createDataFrame([(*d, 9, "h") for d in docs], schema)
    tests = spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, doc_id long")
    want = Counter()
    for i, text in items:
        words = decontaminate.WORD((text or "").lower())
        own = decontaminate.shingles(words, min(5, len(words))) if words else set()
        for d, doc in docs:
            found = decontaminate.shingles(decontaminate.WORD((doc or "").lower()), min(5, len(words)))
            if own and len(own & found) >= 0.8 * len(own):
                want[d, i, len(own & found)] += 1
    cases.frame(spark)
    got = Counter((r["doc_id"], r["item_id"], r["n_shared"])
                  for r in decontaminate.matches(df, tests).collect())
    assert got == want and (1, 1, 26) in got and got[6, 7, 32] == 2
    clean = decontaminate.clean(df, tests)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == (
        {d for d, _ in docs} - {d for d, _, _ in want})
    assert decontaminate.matches(df, tests.limit(0)).count() == 0
    assert decontaminate.clean(df, tests.limit(0)).count() == len(docs)
    odd = cases.frame(spark)
    assert cases.ids(decontaminate.clean(odd, tests).collect()) == cases.all_ids()


def test_decontaminate_in_blocks(spark):
    rng = random.Random(8)
    rows = [(i, cases.prose(rng, 20)) for i in range(40)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = [text for _, block in decontaminate.item_blocks(items, 1500) for _, text in block]
    assert sorted(found) == sorted(t for _, t in rows)


def test_attention_gradient_and_windows():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, attention.INPUTS, (3, attention.WIDTH))
    goal = rng.integers(-1, attention.CLASSES, (3, attention.WIDTH))
    w = {k: v.astype(np.float64) for k, v in attention.initial().items()}

    def loss():
        live = goal >= 0
        z, odds = attention.class_odds(w, attention.forward(w, rows)[-1][live])
        return -(z[np.arange(live.sum()), goal[live]] - np.log(odds.sum(axis=1))).mean()

    grad = attention.gradient(w, rows, goal)
    for k, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[k][at] += 1e-5
        up = loss()
        w[k][at] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[at], rel=1e-3)
        w[k][at] += 1e-5
    for n in (0, 1, attention.WIDTH - 1, attention.WIDTH, 100):
        ids = rng.integers(0, 50, n)
        ins, outs, first, _ = attention.windows([ids], 50, attention.STRIDE)
        scored = outs[(outs >= 0) & (np.arange(attention.WIDTH) >= first[:, None])]
        assert scored.tolist() == [*ids.tolist(), 50]


def test_lm_scores(spark):
    df = cases.frame(spark)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    split = lambda t: re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    count, ends = Counter(), 0
    for i, t, *_ in cases.rows():
        if not held(i):
            count.update(split(t))
            ends += 1
    total, size = sum(count.values()) + ends, len(count) + 1
    want = Counter()
    for i, t, *_ in cases.rows():
        words = split(t)
        base = sum(math.log10(count[w] + 1) for w in words) + math.log10(ends + 1)
        want[i, held(i), len(words) + 1, sum(count[w] > 0 for w in words) + 1, total,
             round(base - (len(words) + 1) * math.log10(total + size + 1), 6)] += 1
    rows = lm.scores(df, RANKS, vocabularies.PATTERN).collect()
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in rows)
    assert got == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert lm.scores(df.limit(0), RANKS, vocabularies.PATTERN).count() == 0


def test_frequent_words_are_bounded(spark):
    counts = spark.createDataFrame([(b"a", 9), (b"b", 5), (b"c", 5), (b"d", 1)], "word binary, n long")
    assert [lm.cut_off(counts, most) for most in (4, 3, 2, 1)] == [1, 5, 9, 9]
    assert lm.cut_off(counts, 0) > 1 << 60 and lm.cut_off(counts.limit(0), 3) > 1 << 60


def test_lm_join_path(spark, monkeypatch):
    """Few frequent words: the others meet their counts in the join."""
    rng = random.Random(4)
    df = spark.createDataFrame([(i, cases.prose(rng, 30)) for i in range(60)], "doc_id long, text string")
    cases.frame(spark)
    score = lambda: {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in
                     lm.scores(df, RANKS, vocabularies.PATTERN).collect()}
    whole = score()
    monkeypatch.setattr(lm, "FREQUENT", 3)
    assert score() == whole


def test_a_batch_without_padding_has_the_same_gradient():
    """Windows of padding alone add nothing, and the batch without them takes the short way."""
    rng = np.random.default_rng(3)
    w = attention.initial()
    rows, goal = rng.integers(0, attention.INPUTS, (20, 16)), rng.integers(0, attention.CLASSES, (20, 16))
    padded = np.concatenate([goal, np.full((5, 16), -1)])
    whole = attention.gradient(w, rows, goal)
    mixed = attention.gradient(w, np.concatenate([rows, rows[:5]]), padded)
    assert all(np.allclose(whole[k], mixed[k], atol=1e-5) for k in attention.SHAPES)
    seen, over = (attention.class_odds(w, np.ones((4, attention.DIM + 1), np.float32), x)[1] for x in (False, True))
    assert (seen == over).all()
