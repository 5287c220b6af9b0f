"""Vector codes, importance resampling and language identification against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from tradewind.llm import codes, language, queries, resampling

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, salt int, same int"


# Vector codes.

def test_tree_equals_all_distances():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 4, 8):
        for spread in (2, 10, 100, 1 << 26):
            for n in (1, 2, 7, 64, 200):
                entries = rng.integers(-spread, spread + 1, (n, dim))
                asked = np.concatenate([rng.integers(-spread, spread + 1, (300, dim)), entries])
                index, best = codes.Gnat(entries).nearest(asked)
                full = codes.squared(asked[:, None], entries[None])
                assert (full.argmin(1) == index).all() and (full.min(1) == best).all()


def test_tree_leaves_most_entries_out():
    rng = np.random.default_rng(2)
    tree = codes.Gnat(np.floor(rng.normal(0, 30, (64, 4))).astype(np.int64))
    tree.nearest(np.floor(rng.normal(0, 30, (1000, 4))).astype(np.int64))
    assert tree.compared < 1000 * 32


def coded(rows, parts=16, entries=64, rounds=2):
    """What the contract says, with plain loops."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    able = [r for r in kept if len(r[1]) == len(kept[0][1]) and all(abs(x) < codes.LARGEST for x in r[1])]
    whole = [[math.floor(256 * x) for x in r[1]] for r in able]
    width = len(whole[0]) // parts
    cut = [[tuple(w[p * width:(p + 1) * width]) for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        nearest = [[near(p, q)[1] for p, q in enumerate(c)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, at in zip(cut, nearest, strict=True) if at[p] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    found = {}
    for r, c in zip(able, cut, strict=True):
        last = [near(p, q) for p, q in enumerate(c)]
        found[id(r)] = "".join(f"{i:02x}" for _, i in last), sum(d for d, _ in last)
    by_label = Counter()
    for r in able:
        by_label[r[2]] += found[id(r)][1]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], *found.get(id(r), (None, None)), by_label[r[2]] if r[2] in by_label else None, sha) for r in kept]


def vectors():
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 0.3, 32).astype(np.float32).tolist(), int(i) % 3, "c", 1, 2, 3) for i in range(100)]
    rows += [(i, rows[5][1], None, "c", 1, 2, 3) for i in range(200, 260)]  # copies, null labels
    rows += [(7, rows[8][1], 1, "c", 1, 2, 3), (None, rows[9][1], 1, "c", 1, 2, 3), (7, rows[8][1], 1, "c", 1, 2, 3)]
    rows += [(300, None, 1, "", 1, 2, 3), (301, [None] * 32, 1, "", 1, 2, 3), (302, [math.nan] * 32, 1, "", 1, 2, 3),
             (303, [math.inf] * 32, 1, "", 1, 2, 3), (304, [1.0] * 16, 1, "", 1, 2, 3), (305, [], 9, "", 1, 2, 3),
             (306, [1e30] * 32, 1, "", 1, 2, 3), (307, [-0.0039062] * 32, 1, "", 1, 2, 3)]
    return rows


def test_codes_equal_plain_loops(spark):
    cases.frame(spark)
    for rows in (vectors(), vectors()[:3]):
        got = codes.report(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(map(tuple, got), key=key) == sorted(coded(rows), key=key)


def test_codes_of_nothing(spark):
    cases.frame(spark)
    none = spark.createDataFrame([], VECTORS)
    assert codes.report(none).collect() == []
    bad = spark.createDataFrame([(1, [1.0, 2.0], 1, "", 1, 1, 1)], VECTORS)
    assert [r["code"] for r in codes.report(bad).collect()] == [None]


def test_decode_returns_the_entries(spark):
    cases.frame(spark)
    rows = codes.valid(spark.createDataFrame(vectors()[:80], VECTORS))
    ready, books = codes.fit(rows)
    found = codes.coded(ready, books).filter("error = 0").join(rows, "vec_id").select("code", "vector").collect()
    for code, vector in found:
        assert np.abs(books.decode([code])[0] - np.array(vector)).max() <= 0.5 / codes.SCALE + 1e-12


# Importance resampling.

def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resampled(docs, target):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(buckets(x))
    for x in target:
        t.update(buckets(x))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
            for b in range(10000)]
    out = []
    for i, x in docs:
        found = buckets(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words(x))])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for place, row in enumerate(able[:5 * len(able) // 100], 1):
        row[4] = place
    return [tuple(r[:5]) for r in out]


def text(rng):
    return "".join(rng.choices("ab É\n-9Z" + chr(0x1F600), k=rng.randint(0, 80)))


def test_scanner_emits_every_run():
    rng = random.Random(1)
    odd = ["", "a", "a b", "A-b", "x" * 253 + " " + "y" * 254 + " " + "v" * 255 + " " + "z" * 256 + " r " + "x" * 900,
           " ", "é ſ K", "1 2 3 4", cases.LONG] + [text(rng) for _ in range(500)]
    scan = resampling.Scanner()
    assert scan([]) == []
    for n, found in zip((len(odd), 1), (scan(odd), [scan([x])[0] for x in odd]), strict=True):
        assert [(k, Counter(b.tolist())) for k, b in found] == [(len(words(x)), Counter(buckets(x))) for x in odd], n


def test_resampling_equals_plain_counting(spark):
    docs = cases.frame(spark)
    rng = random.Random(5)
    more = [(i, " ".join(text(rng) for _ in range(4))) for i in range(1000, 1200)]
    extra = spark.createDataFrame([(*m, *r[2:]) for m in more for r in cases.rows()[:1]], cases.NAMES)
    target = spark.createDataFrame([(1, "river1 stone2 walk3"), (2, None), (3, more[3][1])], "item_id long, text string")
    pairs = [(r[0], r[1]) for r in cases.rows()] + more
    got = Counter(map(tuple, resampling.resample(docs.union(extra), target).collect()))
    want = resampled(pairs, ["river1 stone2 walk3", None, more[3][1]])
    assert got == Counter(want) and sum(r[4] is not None for r in want) > 5
    assert resampling.resample(docs.limit(0), target).count() == 0
    alone = resampling.resample(docs, target.limit(0)).collect()
    assert Counter(map(tuple, alone)) == Counter(resampled(pairs[:len(cases.rows())], []))


def test_repeated_rows_share_the_draw(spark):
    cases.frame(spark)
    rng = random.Random(9)
    docs = [(i, cases.prose(rng, 30)) for i in range(20)] + [(3, cases.prose(random.Random(1), 40))] * 100
    target = spark.createDataFrame([(1, docs[-1][1])], "item_id long, text string")
    found = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), target).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5, 6]
    assert Counter(map(tuple, found)) == Counter(resampled(docs, [docs[-1][1]]))


def test_resampling_on_the_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.JOBS["op12_resampling"](spark, SF).collect()
    assert Counter(map(tuple, got)) == Counter(resampled(docs, items))


# Language identification.

def plain_trigrams(x):
    out = []
    for word in "".join(c if c.isalpha() else " " for c in x.lower()).split():
        full = f"\0\0{word}\0"
        out.append([full[i:i + 3] for i in range(len(full) - 2)])
    return out


def test_trigrams_are_those_of_the_words():
    rng = random.Random(2)
    texts = ["", "a", "Ab c", "12", "İx ſ", "x" * 50] + [
        "".join(rng.choices("aB é1\n-\0" + chr(0x1F600), k=rng.randint(0, 40))) for _ in range(300)]
    grams, first, ends = language.trigrams(texts)
    seen = {}
    at = 0
    for i, x in enumerate(texts):
        plain = plain_trigrams(x)
        assert ends[i + 1] - ends[i] == len(plain), x
        for word in plain:
            assert first[at] == sum(map(len, sum([plain_trigrams(y) for y in texts[:i]], []))) + sum(
                map(len, plain[:plain.index(word)])) or plain.count(word) > 1
            got = grams[first[at]:first[at + 1] if at + 1 < len(first) else len(grams)]
            assert len(got) == len(word)
            for gram, bucket in zip(word, got.tolist(), strict=True):
                assert seen.setdefault(gram, bucket) == bucket
            at += 1
    assert len(set(seen.values())) > 0.95 * len(seen)


def plain_pick(logs):
    """Mixture of one text's words [word][language] by the docstring, in plain loops."""
    n, names = len(logs), range(len(logs[0]))
    single = [sum(w[j] for w in logs) for j in names]
    best = max(single)
    chosen = {single.index(best): 1.0}
    allowed = list(names)
    limit = sum(max(w) for w in logs)
    penalty = math.log(n) / 2
    while len(allowed) > 1 and limit - penalty > best:
        share = {j: 1 / len(allowed) for j in allowed}
        for _ in range(language.STEPS):
            new = dict.fromkeys(allowed, 0.0)
            for w in logs:
                top = max(w[j] for j in allowed)
                part = {j: math.exp(w[j] - top) * share[j] for j in allowed}
                for j in allowed:
                    new[j] += part[j] / sum(part.values()) / n
            still = max(abs(new[j] - share[j]) for j in allowed) >= language.CLOSE
            share = new
            if not still:
                break
        limit = sum(math.log(sum(math.exp(w[j] - max(w[k] for k in allowed)) * share[j] for j in allowed))
                    + max(w[k] for k in allowed) for w in logs)
        kept = [j for j in allowed if share[j] > language.CLOSE]
        if limit - penalty * (len(kept) - 1) > best:
            best = limit - penalty * (len(kept) - 1)
            total = sum(share[j] for j in kept)
            chosen = {j: share[j] / total for j in kept}
        least = min(kept, key=lambda j: share[j])
        allowed = [j for j in kept if j != least]
    return chosen


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cases.frame(spark)
    return docs, language.fit(docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0"))


def test_mixtures_equal_plain_loops(trained):
    docs, model = trained
    texts = [r["text"] or "" for r in docs.select("text").limit(60).collect()]
    texts += [a[:300] + " " + b[:k] for k in (60, 200, 400) for a, b in zip(texts, texts[7:])] + ["", "1", "é", "the"]
    found = language.pick(texts, model)
    for x, share in zip(texts, found, strict=True):
        logs, _ = model.word_logs([x])
        if not logs.shape[1]:
            assert share is None and not any(c.isalpha() for c in x)
        else:
            want = plain_pick(logs.T.tolist())
            got = {j: share[j] for j in np.flatnonzero(share)}
            assert got.keys() == want.keys() and all(abs(got[j] - want[j]) < 1e-9 for j in want)
            alone = language.pick([x], model)[0]
            assert (alone == share).all()  # other texts of the block play no part


def test_held_out_accuracy_and_planted_mixtures(spark, trained):
    docs, model = trained
    rows = {r["doc_id"]: r for r in language.report(docs).collect()}
    given = {r["doc_id"]: r for r in docs.collect()}
    assert rows.keys() == given.keys()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    out = [i for i in rows if rows[i]["held_out"] and given[i]["lang"]]
    right = sum(rows[i]["lang_pred"] == given[i]["lang"] for i in out)
    assert right >= 0.97 * len(out)
    one = {lang: [r["text"] for r in given.values() if r["lang"] == lang and len(r["text"] or "") > 1500][:12]
           for lang in ("de", "fr", "en", "es")}
    for a, b in (("de", "fr"), ("en", "es"), ("fr", "en")):
        for x, y in zip(one[a], one[b], strict=True):
            share = language.pick([x[:900] + "\n" + y[:500]], model)[0]
            held = dict(zip(model.names, share.tolist(), strict=True))
            assert held[a] > held[b] > 0.15


def test_language_of_odd_rows(spark):
    rows = cases.frame(spark)
    found = language.report(rows).collect()  # no label at all
    assert cases.ids(found) == cases.all_ids()
    assert {r["lang_pred"] for r in found} == {"und"} and {r["score"] for r in found} == {0.0}
    labelled = rows.withColumn("lang", rows["source"]).fillna("xx", ["lang"])
    found = language.report(labelled).collect()
    text = dict((r[0], r[1]) for r in cases.rows())
    for r in found:
        if r["doc_id"] is not None:
            none = not any(c.isalpha() for c in text[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == none
    assert language.report(labelled.limit(0)).count() == 0
    many = spark.createDataFrame([(i, f"word {i}", f"l{i}") for i in range(500)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language.report(many)
    assert language.report(many.filter("doc_id < 80")).count() == 80
