"""Personal data and secrets against plain regular expressions."""

import base64
import hashlib
import os
import random
import re

import cases
from pyspark.sql import functions as F

from tradewind.llm import pii, secrets

PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
SECRETS = [("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
            r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
           ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m[0])
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 9 <= len(digits) <= 15, "assign": lambda: len(m[2]) >= 6,
            "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]()


def expected(text, patterns):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(patterns)
             for m in re.finditer(p, text or "") if holds(kind, m)]
    return ",".join(f"{patterns[k][0]}:{s}:{e}" for s, k, e in sorted(found))


def scrambled(parts, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


def check(spark, report, patterns, texts):
    schema = "doc_id long, text string, base string, spans string, hash long, seed boolean"
    df = spark.createDataFrame([(i, t, "b", "s", 1, True) for i, t in enumerate(texts)], schema)
    rows = {r["doc_id"]: r for r in report(df).collect()}
    for i, text in enumerate(texts):
        base = expected(text, patterns)
        assert rows[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), text
        assert not base or set(base.split(",")) <= set(rows[i]["spans"].split(","))
        for kind, _ in patterns:
            assert rows[i][f"n_{kind}"] == len(re.findall(rf"\b{kind}:", base))
    return rows


def test_pii_base(spark):
    cases.frame(spark)
    texts = scrambled(["a", "@", ".", "-", " ", "1", "2", "25", "256", "007", "+", "(", ")", "é", "\n",
                       "_", "%", "\U0001F600", "4111111111111111", "a@b.co"], 400, 5)
    texts += [None, "", "1" * 5000 + " " + "a@" * 3000 + "+1" * 2000, "x" * 50_000]
    check(spark, pii.report, PII, texts)


def test_pii_contexts_add_unseen_identifiers(spark):
    seeds = [(i, f"Contact: user{i}@mail.com thanks") for i in range(8)]
    rows = {r["doc_id"]: r for r in pii.report(spark.createDataFrame(
        [*seeds, (90, "Contact: joe@localhost thanks"), (91, "about joe@localhost2 here"),
         (92, "Contact: 12345 thanks"), (93, "no identifiers at all")],
        "doc_id long, text string")).collect()}
    assert rows[90]["spans"] == "email:9:22" and rows[90]["n_email"] == 0
    assert [rows[i]["spans"] for i in (91, 92, 93)] == ["", "", ""]
    assert all(rows[i]["n_added"] == 0 for i in range(8))


def test_pii_contexts_add_numbers_in_groups(spark):
    valid = [n for n in range(4111111111110000, 4111111111111000) if luhn(str(n))][:8]
    docs = [(i, f"phone: +44 20 7946 01{i:02} now") for i in range(8)]
    docs += [(10 + i, f"cardno {n} paid") for i, n in enumerate(valid)]
    want = {90: ("phone: 020 7946 0958 now", "phone:7:20"), 91: ("phone: (020) 7946 0958 now", "phone:7:22"),
            92: ("cardno 4111 1111 1111 1112 paid", "card:7:26"), 93: ("about 020 7946 0959 here", ""),
            94: ("room 7 5551234567 now", "phone:7:17")}
    rows = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(
        docs + [(i, t) for i, (t, _) in want.items()], "doc_id long, text string")).collect()}
    assert {i: rows[i] for i in want} == {i: s for i, (_, s) in want.items()}


def test_pii_rounds_go_on(spark):
    name = "abcdefgh"
    docs = [(0, f"a: seed{i}@mail.com") for i in range(8)] + [(0, "a: x0@host"), (0, "a: y0@host")]
    for k in range(1, 8):  # each context becomes confident by what the one before has found
        docs += [(k, f"{name[k]}: more{k}x{i}@mail.com") for i in range(5)]
        docs += [(k, f"{name[k]}: {x}{k - 1}@host") for x in "xy"]
        docs += [(100 + k, f"{name[k]}: {x}{k}@host") for x in "xy"]
    rows = pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["spans"] for r in rows if r["doc_id"] > 100} == {"email:3:10"}


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes(
        (n.bit_length() + 7) // 8)
    return bytes([tag]) + size + body


def number(n):
    return der(2, b"\0" + os.urandom(n))


RSA = der(0x30, der(2, b"\0") + b"".join(map(number, (128, 3, 128, 64, 64, 64, 64, 64))))


def test_secrets_base(spark):
    texts = scrambled(["password", "Token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abc123", "deadbeef",
                       "AKIA", "ABCD", "\n", "ſecret", "toKen", "0123456789abcdef01234567", "é"], 400, 6)
    check(spark, secrets.report, SECRETS, [*texts, None, "", "a" * 50_000, "-----BEGIN KEY-----" * 2000])


def test_secrets_structure():
    assert secrets.is_key(RSA) and not secrets.is_key(RSA[:-1]) and not secrets.is_key(b"\x30" * 500)
    field = lambda b: len(b).to_bytes(4) + b
    assert secrets.is_wire(field(b"ssh-ed25519") + field(os.urandom(32)))
    assert not secrets.is_wire(os.urandom(60))
    url = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    head, body = url(b'{"alg":"HS256"}'), url(b'{"sub":"me"}')
    for size, found in ((32, ["token"]), (31, [])):
        text = f"x {head}.{body}.{url(os.urandom(size))} y"
        assert [kind for _, kind, _ in secrets.confirmed_spans(text)] == found
    text = f"k {base64.b64encode(RSA).decode()} {RSA.hex()} " + base64.b64encode(os.urandom(300)).decode()
    assert [kind for _, kind, _ in secrets.confirmed_spans(text)] == ["der", "der"]


def test_odd_documents(spark):
    df = cases.frame(spark)
    for report in (pii.report, secrets.report):
        assert cases.ids(report(df).collect()) == cases.all_ids()
        assert report(df.limit(0)).count() == 0


def test_pii_of_one_long_text(spark):
    """Positions are summed in blocks and seeds found by halving: the same at every length."""
    for n in (31, 33, 64, 65, 40_000):
        text = "".join(f"a{i}@b.cc, " for i in range(n))
        row = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        want = ",".join(f"email:{m.start()}:{m.end()}" for m in re.finditer(r"a[0-9]+@b\.cc", text))
        assert row["n_email"] == n and row["spans"] == want and row["n_added"] == 0


def test_pii_overlap_by_halving(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(200):
        cuts = sorted(rng.sample(range(60), 2 * rng.randrange(6)))
        s = rng.randrange(58)
        rows.append(([(a, 0, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)], s,
                     s + rng.randrange(1, 4)))
    df = spark.createDataFrame(rows, "spans array<struct<s:int,k:int,e:int>>, s int, e int")
    for r in df.withColumn("over", pii.over(F.col("spans"), F.col("s"), F.col("e"))).collect():
        assert r["over"] == any(x["s"] < r["e"] and x["e"] > r["s"] for x in r["spans"])
