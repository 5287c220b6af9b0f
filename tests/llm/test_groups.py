"""Sharding, SimHash, line dedup and repeated passages against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tradewind.llm import linededup, links, sharding, simhash, substrings
from tradewind.llm.components import components


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    cases.frame(spark)
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 300)] + [(500, 500)]
    pairs += [(rng.randrange(600, 900), rng.randrange(600, 900)) for _ in range(150)]
    rng.shuffle(pairs)
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in found.collect()} == roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("large", [4096, 5])
def test_simhash_links(spark, large):
    rng = np.random.default_rng(3)
    values = set(rng.integers(-2**63, 2**63 - 1, 60).tolist())
    for v in list(values)[:25]:
        for _ in range(6):
            x = v & (2**64 - 1)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            values.add(simhash.signed(x))
    values = sorted(values)
    bits = np.array(values, np.int64).view(np.uint64)
    near = [(values[i], values[j]) for i in range(len(bits)) for j in range(i)
            if int(bits[i] ^ bits[j]).bit_count() <= 3]
    cases.frame(spark)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = [(r["a"], r["b"]) for r in simhash.links(df, large=large).collect()]
    assert roots(values, found) == roots(values, near)
    assert len(simhash.near_pairs(np.zeros(len(values), int), np.array(values))) < len(values)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_rows(spark):
    df = cases.frame(spark)
    rows = simhash.report(df).collect()
    assert cases.ids(rows) == cases.all_ids()
    prints = [(r[0], fingerprint(r[1])) for r in cases.rows()]
    group = roots({p for _, p in prints}, [(a, b) for _, a in prints for _, b in prints
                                           if (a ^ b).bit_count() <= 3])
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[group[p]].append(i)
    want = Counter((i, format(p, "016x"), min(least[group[p]], default=None)) for i, p in prints)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == want
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(fingerprint(r["text"]) for r in kept.collect()) and kept.count() == len(set(group.values()))
    assert simhash.report(df.limit(0)).count() == 0


def check_shards(rows, docs, shards, slack):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    mean, most = sum(r["size"] for r in rows) / shards, max(r["size"] for r in rows)
    for shard in range(shards):
        assert abs(sum(r["size"] for r in by[shard]) - mean) <= most + slack * mean


def test_shards(spark):
    df = cases.frame(spark)
    check_shards(sharding.report(df, 7).collect(), [r[:2] for r in cases.rows()], 7, 0.02)
    rng = random.Random(6)
    docs = [(i, cases.prose(rng, rng.randint(1, 80))) for i in range(4000)]
    docs += [(5000 + i, "a hot text") for i in range(3000)] + [(None, None)] * 2000
    many = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = sharding.report(many, 40).collect()
    check_shards(rows, docs, 40, 0.02)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    assert sharding.report(df.limit(0), 40).count() == 0


def test_equal_rows_are_divided_over_tasks(spark):
    cases.frame(spark)
    same = spark.range(0, 300_000, numPartitions=8).selectExpr("cast(null as long) doc_id", "cast(null as string) text")
    few = spark.range(0, 3000).selectExpr("id doc_id", "'t' || id text")
    rows = sharding.split(sharding.sizes(same.union(few), "doc_id", "text"), 40)
    assert rows.groupBy("range").count().agg({"count": "max"}).first()[0] < 3030
    counts = [r["count"] for r in sharding.report(same, 40).groupBy("shard").count().collect()]
    assert len(counts) == 40 and max(counts) - min(counts) <= 2


def test_shards_written(spark, tmp_path):
    df = cases.frame(spark).withColumnRenamed("range", "shard_of")
    sharding.write(df, 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert cases.ids(back.collect()) == cases.all_ids() and set(back.columns) == {*df.columns, "shard"}


def test_links_reach_all_holders(spark):
    cases.frame(spark)
    rows = [(k, d, d * 10) for k, n in ((1, 700), (2, 2), (3, 1)) for d in range(n)]
    found = links.linked(spark.createDataFrame(rows, "key long, doc long, at long"), spread=50).collect()
    for key, n in ((1, 700), (2, 2), (3, 1)):
        pairs = [(r["doc"], r["partner"]) for r in found if r["key"] == key]
        assert all(a > b for a, b in pairs) and len(pairs) == n - 1
        assert len(set(roots(range(n), pairs).values())) == 1
    assert all(r["partner_at"] == r["partner"] * 10 for r in found)


def test_few_holders_are_linked_in_all_pairs(spark):
    rows = [(1, d, d) for d in range(8)] + [(2, d, d) for d in range(9)] + [(3, 5, 0), (4, 1, 7), (4, 6, 8)]
    occurrences = spark.createDataFrame(rows, "key long, doc long, at long")
    found = [tuple(r) for r in links.linked(occurrences, few=8).collect()]
    assert sorted(found) == sorted(
        [(1, 8, d, d, p, p) for d in range(8) for p in range(d)] +
        [(2, 9, d, d, d - 1, d - 1) for d in range(1, 9)] + [(4, 2, 6, 8, 1, 7)])


def test_patience():
    assert linededup.aligned(list("abcdef"), list("xbcyef")) == [(1, 1), (2, 2), (4, 4), (5, 5)]
    assert linededup.aligned(list("aab"), list("aab")) == [(0, 0), (1, 1), (2, 2)]
    assert linededup.aligned([], list("a")) == []
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in "ab")
        found = linededup.aligned(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:], strict=False))


def test_line_dedup(spark):
    cases.frame(spark)
    a, b, c, d = ("alpha beta gamma", "delta eps zeta", "eta theta iota", "kappa la mu")
    docs = [(1, f"{a}\n{b}\n{c}"), (2, f"{d}\n{a}\n{b}"), (3, f"{a}\n{b}\n{c}"), (None, f"{d}\nnu xi omicron"),
            (None, None), (5, ""), (7, "one line here"), (7, "one line here"), (8, f"two words\n{c}")]
    df = spark.createDataFrame([(i, t, "x", "b") for i, t in docs],
                               "doc_id long, text string, lines string, bitmap string")
    done = linededup.dedup(df)
    assert done.columns == [*df.columns, "n_removed"]
    got = Counter((r["doc_id"], r["text"], r["n_removed"]) for r in done.collect())
    assert got == Counter([(1, docs[0][1], 0), (2, d, 2), (3, "", 3), (None, "nu xi omicron", 1),
                           (None, None, 0), (5, "", 0), (7, "one line here", 0), (7, "one line here", 0),
                           (8, "two words", 1)])
    assert linededup.dedup(df.limit(0)).count() == 0
    assert cases.ids(linededup.dedup(cases.frame(spark)).collect()) == cases.all_ids()


def test_a_line_goes_by_the_same_rule_among_few_and_many(spark):
    """The share of the documents that hold a line plays no part: it stays in the first."""
    rng = random.Random(5)
    docs = [(i, f"this line is everywhere\n{cases.prose(rng, 9)}") for i in range(100)]
    others = [(i, cases.prose(rng, 12)) for i in range(1000, 4000)]
    found = [linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
             .filter("n_removed > 0").select("doc_id", "text").collect() for rows in (docs, docs + others)]
    assert sorted(found[0]) == sorted(found[1]) and cases.ids(found[0]) == list(range(1, 100))


def test_python_runs_once_per_document(spark):
    """Filters and joins beside a Python function may make it run twice."""
    docs = cases.frame(spark)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kept = []
    keep = linededup.stored
    linededup.stored = lambda df, name: kept.append(plan(df)) or keep(df, name)
    try:
        linededup.dedup(docs)
    finally:
        linededup.stored = keep
    assert all(p.count("ArrowEvalPython") <= 1 for p in kept) and kept


def test_holders_alone_do_not_keep_a_line(spark):
    rng = random.Random(6)
    many = cases.prose(rng, 60)
    docs = [(i, f"{many}\n{cases.prose(rng, 9)}") for i in range(100)]
    done = linededup.dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r[0] for r in done.filter("n_removed = 1").collect()) == list(range(1, 100))
    for size in (100, 500):  # the same share of the documents, 10 and 70 and more holders
        docs = [(i, cases.prose(rng, 9) + "\nunder the same licence" * (i % 7 == 0)) for i in range(size)]
        done = linededup.dedup(spark.createDataFrame(docs, "doc_id long, text string"))
        assert sorted(r[0] for r in done.filter("n_removed = 1").collect()) == list(range(7, size, 7))


def test_neighbouring_lines_with_other_holders(spark):
    """A block of two short lines, the first of which also stands alone in most others."""
    rng = random.Random(7)
    kind = ["block"] * 1400 + ["alone"] * 900
    rng.shuffle(kind)
    docs = [(i, {"block": "home about contact\n\nsign in here", "alone": "home about contact"}[k]
             + "\n" + cases.prose(rng, 9)) for i, k in enumerate(kind)]
    done = linededup.dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    gone = {r[0]: r[1] for r in done.filter("n_removed > 0").select("doc_id", "n_removed").collect()}
    first = kind.index("block")  # no earlier one has its other lines
    assert gone == {i: 3 if k == "block" and i != first else 1 for i, k in enumerate(kind) if i}


def chain_score(chain):
    gaps = sum(substrings.GAP_COST * (c - a + d - b) for (a, b), (c, d) in zip(chain, chain[1:], strict=False))
    return substrings.K * len(chain) - gaps


def test_chains():
    rng = random.Random(2)
    for _ in range(150):
        matches = [(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randint(1, 9))]
        found = substrings.chains(matches)
        assert sorted(m for c in found for m in c) == sorted(set(matches))
        for chain in found:
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(chain, chain[1:], strict=False))
        best = {}
        for m in sorted(set(matches)):
            best[m] = max([substrings.K, *(best[o] + substrings.K - substrings.GAP_COST * (
                m[0] + m[1] - o[0] - o[1]) for o in best if o[0] < m[0] and o[1] < m[1])])
        assert chain_score(found[0]) == pytest.approx(max(best.values()))


def test_repeated_passages(spark):
    cases.frame(spark)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    exact, fuzzy, short = make(60), make(120), make(30)
    changed = lambda w: [rng.choice(words) if rng.random() < 0.04 else x for x in w]
    docs = [(i, " ".join(make(100) + exact + make(80))) for i in range(30)]
    docs += [(100 + i, " ".join(make(50) + changed(fuzzy) + make(50)).title()) for i in range(15)]
    docs += [(200 + i, " ".join(make(90) + short + make(90))) for i in range(20)]
    docs += [(300, " ".join(make(30) + exact + make(30) + exact)), (None, docs[0][1]), (400, docs[35][1]),
             (400, docs[35][1]), (401, None), (402, ""), (403, "İ " * 20 + " ".join(exact))]
    df = spark.createDataFrame([(i, t, 1, "d") for i, t in docs],
                               "doc_id long, text string, chain long, data string")
    rows = substrings.repeated(df).collect()
    held = {r["doc_id"] for r in rows} | {r["other_id"] for r in rows}
    assert held == {*range(30), *range(100, 115), 300, 400, 403, None}
    text = dict(docs)
    for r in rows:
        mine = text[r["doc_id"]][r["start"]:r["end"]].lower().split()
        other = text[r["other_id"]][r["other_start"]:r["other_end"]].lower().split()
        assert min(len(mine), len(other)) >= r["n_words"] >= 50 and r["similarity"] >= 0.8
        if r["doc_id"] in (300, 403):
            assert mine[:60] == exact[:60] or mine[-60:] == exact[-60:]
    assert sum(r["doc_id"] == 300 for r in rows) == 2  # both places
    assert [(r["other_id"], r["similarity"]) for r in rows if r["doc_id"] == 400] == [(105, 1.0)]
    assert len(rows) < 120
    assert substrings.repeated(df.limit(0)).count() == 0
    odd = substrings.repeated(cases.frame(spark)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in odd} >= {(20, 1), (21, 1), (None, 2)}


def test_bad_gap_ends_a_passage():
    rng = random.Random(8)
    own = lambda n, name: [f"{name}{rng.randrange(10**9)}" for _ in range(n)]
    for n, gap in ((50, 30), (55, 35), (59, 40)):
        p, q, stray = own(n, "p"), own(n, "q"), own(5, "s")
        # Passages with words of their own between; one passage with a stray phrase near it.
        a, b = ([*own(20, x), *p, *own(gap, x), *q, *own(20, x)] for x in "ab")
        chain = [(20 + k, 20 + k) for k in (1, n - 6, n + gap + 1, 2 * n + gap - 6)]
        pairs = substrings.align(a, b, chain)
        found = substrings.similar(pairs)
        assert [(pairs[f], pairs[e]) for f, e in found] == [
            ((s, s), (s + n - 1, s + n - 1)) for s in (20, 20 + n + gap)]
        a, b = ([*p, *own(35, x), *stray, *own(9, x)] for x in "ab")
        pairs = substrings.align(a, b, [(1, 1), (n - 6, n - 6), (n + 35, n + 35)])
        assert [(pairs[f], pairs[e]) for f, e in substrings.similar(pairs)] == [((0, 0), (n - 1, n - 1))]


def test_similar_stretches_against_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        a = [f"w{rng.randrange(10**9)}" for _ in range(130)]
        rate = rng.choice([0.05, 0.15, 0.2, 0.25])
        b = [x if rng.random() > rate else "other" for x in a]
        pairs = substrings.align(a, b, [])
        good = [(f, e) for f in range(len(pairs)) for e in range(f, len(pairs))
                if pairs[e][0] - pairs[f][0] >= 49 and
                2 * (e - f + 1) >= 0.8 * 2 * (pairs[e][0] - pairs[f][0] + 1) - 1e-9]
        found = substrings.similar(pairs)
        assert set(found) <= set(good) and bool(found) == bool(good)
        assert all(any(f <= y and x <= e for x, y in found) for f, e in good)


def test_short_fuzzy_passages_and_neighbours(spark):
    rng = random.Random(12)
    make = lambda n, name="w": [f"{name}{rng.randrange(20_000)}" for _ in range(n)]
    docs, n = [], 40
    for i in range(n):  # 60 words with 15 % of them changed
        p, at = make(60), set(rng.sample(range(1, 59), 9))
        q = [f"x{rng.randrange(10**6)}" if k in at else w for k, w in enumerate(p)]
        docs += [(2 * i, " ".join(make(60) + p + make(60))), (2 * i + 1, " ".join(make(70) + q + make(40)))]
    p, q = make(55), make(55)
    docs += [(1000 + i, " ".join(make(30) + p + make(35) + q + make(30))) for i in range(2)]
    rows = substrings.repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len({r["doc_id"] for r in rows if r["doc_id"] < 1000}) >= n - 1
    text = dict(docs)
    got = sorted(text[r["doc_id"]][r["start"]:r["end"]].split() for r in rows if r["doc_id"] == 1001)
    assert got == sorted([p, q])


@pytest.mark.parametrize("parts", [1, 12])
def test_a_passage_whose_parts_stand_nearer_elsewhere(spark, parts):
    rng = random.Random(21)
    make = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    docs, n = [], 2 * parts + 2
    for i in range(10):  # the first and the last document hold the passage, the others a part each
        p, base = make(62), 100 * i
        held = [p, *[p[:36] if k % 2 else p[26:] for k in range(2 * parts)], p]
        docs += [(base + k, " ".join(make(40) + x + make(40))) for k, x in enumerate(held)]
    rows = substrings.repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_id"]) for r in rows} == {(100 * i + n - 1, 100 * i) for i in range(10)}


def test_few_documents_with_a_passage_give_all_pairs(spark):
    rng = random.Random(22)
    make = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p = make(70)
    docs = [(i, " ".join(make(40) + p + make(40))) for i in range(5)]
    rows = substrings.repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_id"]) for r in rows} == {(a, b) for a in range(5) for b in range(a)}


def test_a_word_said_over_and_over_is_one_place(spark):
    rng = random.Random(8)
    own = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = own(55)
    docs = [(1, f"{own(70)} {passage} {own(70)}"),
            (2, f"{own(30)} {passage} {own(20)} {passage} {own(30)} {passage}"),
            (3, own(80) + " it" * 400), (4, own(20) + " it" * 300 + " " + own(9))]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = substrings.repeated(rows).collect()
    twice = {(r["start"], r["end"]) for r in found if r["doc_id"] == 2 and r["other_id"] == 1}
    text = docs[1][1]
    assert twice == {(m.start(), m.end()) for m in re.finditer(re.escape(passage), text)}
    assert any((r["doc_id"], r["other_id"]) == (4, 3) for r in found)
    held = rows.select(F.col("doc_id").alias("doc"), substrings.packed("text").alias("data"))
    places = substrings.seed_table(held).filter("doc = 3").groupBy("key").count()
    assert places.agg(F.max("count")).first()[0] == 8  # 396 places, one in 50 words


def test_every_holder_has_rows_of_its_own(spark):
    rng = random.Random(23)
    make = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p = make(60)
    docs = [(i, " ".join(make(40) + p + make(40))) for i in range(8)] + [(20, " ".join(make(140)))]
    docs += [(30, docs[-1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [tuple(r) for r in substrings.report(df).collect()]
    assert {r[0] for r in rows} == {*range(8), 20, 30}
    assert sorted((*r[3:6], *r[:3], *r[6:]) for r in rows) == sorted(rows)  # in both directions
    once = [tuple(r) for r in substrings.repeated(df).collect()]
    assert len(rows) == 2 * len(once) and set(once) < set(rows)
    text = dict(docs)
    assert all(text[r[0]][r[1]:r[2]] == text[r[3]][r[4]:r[5]] for r in rows)


def test_bounds_before_alignment_lose_nothing():
    rng = random.Random(24)
    found = 0
    for _ in range(600):
        words = rng.choice([4, 30, 10**6])
        a = [f"w{rng.randrange(words)}" for _ in range(rng.randint(50, 90))]
        b = []
        for x in a:
            how = rng.random() / rng.choice([0.1, 0.2, 0.3])
            b += [] if how < 0.3 else ["other"] if how < 0.6 else [x, "more"] if how < 1 else [x]
        good = substrings.similar(substrings.align(a, b, []))
        found += bool(good)
        assert substrings.may_hold(a, b) or not good
    assert found > 100
    assert not substrings.may_hold(a, a[::-1])  # the same words in another order


def test_alignment_against_a_table():
    rng = random.Random(25)
    for _ in range(400):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 30))] for _ in "ab")
        table = [[0] * (len(b) + 1)]
        for x in a:
            row = [0]
            for n, y in enumerate(b):
                row.append(table[-1][n] + 1 if x == y else max(table[-1][n + 1], row[n]))
            table.append(row)
        found = substrings.common(a, b)
        assert len(found) == table[-1][-1] and all(a[i] == b[j] for i, j in found)
        assert all(p < q and r < s for (p, r), (q, s) in zip(found, found[1:], strict=False))


def test_seeds_that_meet_in_arrays(spark):
    from tradewind.llm.frames import ship

    ship(spark)
    rng = random.Random(26)
    docs = [(i << 31, " ".join(rng.choice(["it", "is", f"w{rng.randrange(9)}", f"w{rng.randrange(999)}"])
                               for _ in range(rng.choice([20, 60, 400])))) for i in range(60)]
    held = spark.createDataFrame(docs, "doc long, text string").select("doc", substrings.packed("text").alias("data"))
    rows = [tuple(r) for r in substrings.seed_table(held).collect()]
    n = Counter(key for key, _, _, again in rows if not again)
    assert sorted(map(tuple, substrings.shared_seeds(held).collect())) == sorted(
        (key, n[key], *r) for key, *r in rows if n[key] > 1)
    for _, text in docs:  # the least of all windows, one by one
        words = text.split()
        if len(words) < substrings.MIN_WORDS:
            continue
        runs = substrings.rolling(substrings.hashes(words), substrings.K)
        want = {i for i, x in enumerate(runs) if x < 2**64 // substrings.EVERY}
        want |= {i + int(runs[i:i + substrings.WINDOW].argmin()) for i in range(len(runs) - substrings.WINDOW + 1)}
        assert set(substrings.seeds([words, words])[1].tolist()) == want


def test_links_of_keys_with_known_numbers(spark):
    """The same links whether the numbers of documents come along or are counted."""
    rows = [(1, d, d) for d in range(40)] + [(2, d, 9) for d in range(3)] + [(3, d, 1) for d in range(0, 30, 2)]
    rows += [(4, 1, 1), (4, 6, 2)]
    plain = spark.createDataFrame(rows, "key long, doc long, at long")
    n = Counter(r[0] for r in rows)
    known = spark.createDataFrame([(k, n[k], d, a) for k, d, a in rows], "key long, n long, doc long, at long")
    for few in (2, 5):
        want = sorted(map(tuple, links.linked(plain, spread=8, few=few).collect()))
        found = links.linked(known, spread=8, few=few)
        assert found.columns == ["key", "n", "doc", "at", "partner", "partner_at"]
        assert sorted(map(tuple, found.collect())) == want and len(want) > 50
