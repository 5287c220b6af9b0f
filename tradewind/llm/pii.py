"""Personal data: base patterns, and identifiers found by bootstrapping their contexts.

Base patterns (email, ip, card, phone) are searched leftmost and without overlaps; what
they find are the seed entities. The words before and after a seed are lexical patterns.
Every other token shaped like an identifier is a candidate instance. Patterns and
instances form a graph that is scored in rounds: a pattern's confidence for a kind is
the share of its instances already accepted as that kind, an instance's is the noisy-or
of its confident patterns; accepted instances count as positive in the next round, until
no more are accepted. Candidate numbers may stand in groups with single spaces, hyphens
and a bracketed prefix; their digits decide what they could be.
Accepted candidates are added as spans of that kind. Words common to several kinds never
become confident, so generic contexts add nothing.

Everything runs on built-in functions. Rows are independent but for the graph, which holds
distinct (pattern, instance) edges only: a copied document adds no weight. Null and empty
texts have no spans; repeated rows and null ids keep a result row each. All base spans
stay, and an added span never overlaps one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import stored, texts

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENCE = 3, 0.6
BLOCK = 32

# The patterns, with possessive loops and a look at the character before: the same
# matches without retries inside a run. \G allows a start right after the last match.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?:\G|(?<![^\x20\x09-\x0D]))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
PARTS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
# Candidates in groups: a bracketed prefix goes with the groups after it, and a group of seven
# digits or more after a space is a number of its own.
NEXT = r"(?:[.-][0-9]++|\x20(?![0-9]{7})[0-9]++)"
BRACKETED = rf"\([0-9]++\)[\x20-]?+[0-9]++{NEXT}*+"
GROUPS = r"[0-9]{7,}+(?:-[0-9]++)*+|[0-9]++(?:-[0-9]++|\x20(?![0-9]{7})[0-9]++)*+"
SPANS = "array<struct<s:int,k:int,e:int>>"


def pieces(text: Column, pattern: str) -> Column:
    """Array of (gap before, match); the last gap has an empty match."""
    whole = F.lit(f"(?s)(.*?)(?:({pattern})|\\z)")
    return F.arrays_zip(F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"),
                        F.regexp_extract_all(text, whole, F.lit(2)).alias("hit"))


def bound(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def placed(parts: Column) -> Column:
    """Array of (s, e, gap, hit) with code point positions, e exclusive. Growing an array
    copies it, so lengths are summed in blocks of at least `BLOCK` and of the cube root of
    the number: n parts cost about n ** (4 / 3) copies."""
    none = F.expr("cast(array() as array<struct<s:int,e:int,gap:string,hit:string>>)")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(acc, x):
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["hit"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(
            s.alias("s"), e.alias("e"), x["gap"].alias("gap"), x["hit"].alias("hit")))).alias("out"))

    def in_blocks(parts: Column) -> Column:
        size = F.greatest(F.lit(BLOCK), F.ceil(F.cbrt(F.size(parts))).cast("int"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), size)
        return F.transform(firsts, lambda i: F.aggregate(F.slice(parts, i, size), start, add))

    def moved(blocks: Column) -> Column:
        before = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)")
                                              .alias("all")),
                             lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(
                                 acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])
        return F.flatten(F.zip_with(blocks, before, lambda block, at: F.transform(
            block["out"], lambda x: F.struct((x["s"] + at).alias("s"), (x["e"] + at).alias("e"),
                                             x["gap"].alias("gap"), x["hit"].alias("hit")))))

    return bound(bound(parts, in_blocks), moved)


def over(spans: Column, s: Column, e: Column) -> Column:
    """Whether one of the spans, ascending and disjoint, overlaps s to e: a binary search."""
    def halve(acc, _):
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        ends_later = F.get(spans, middle)["e"] > s
        return F.struct(F.when(ends_later | (acc["lo"] >= acc["hi"]), acc["lo"]).otherwise(middle + 1)
                        .alias("lo"), F.when(ends_later, middle).otherwise(acc["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    first = F.aggregate(rounds, start, halve, lambda acc: acc["lo"])
    return F.when(F.size(spans) > 0, F.coalesce(F.get(spans, first)["s"] < e, F.lit(False))).otherwise(False)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a digit string passes the check sum."""
    def add(total, i):
        digit = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def holds(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.length(hit) > 0
    if kind == "ip":  # parts at most 255, whatever their leading zeros
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    number = digits(hit)
    if kind == "card":
        return F.length(number).between(12, 19) & luhn(number)
    return F.length(number).between(9, 15)


def base_spans(text: Column) -> Column:
    """Per text the spans of all kinds, in the order of the kinds."""
    may = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"),
           "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), "phone": text.contains("+")}
    def of(k: int, kind: str) -> Column:
        kept = F.filter(placed(pieces(text, PARTS[kind])), lambda x: holds(kind, x["hit"]))
        return F.when(may[kind], F.transform(kept, lambda x: F.struct(
            x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"))))

    found = [of(k, kind) for k, kind in enumerate(KINDS)]
    return F.flatten(F.array(*[F.coalesce(x, F.array().cast(SPANS)) for x in found]))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def shape(token: Column) -> Column:
    """The kind, by number, that a token could be of; null for none."""
    n = F.length(digits(token))
    return (F.when(token.rlike(r"^[^@]+@[^@]+$"), 0)
            .when(token.rlike(r"^[0-9]+(?:\.[0-9]+){2,}$"), 1)
            .when(token.rlike(r"^[0-9][0-9-]*(?:\x20[0-9][0-9-]*)*$") & n.between(12, 19), 2)
            .when(token.rlike(r"^\+?[0-9(][0-9().-]*(?:\x20[0-9(][0-9().-]*)*$") & n.between(7, 15), 3))


def occurrences(rows: DataFrame) -> DataFrame:
    """Identifier-like tokens of rows(doc_id, hash, text, base): where they stand, the words
    around them, their kind, and whether a base span makes them a seed."""
    any_part = "|".join([PHONE, EMAIL, IP, BRACKETED, GROUPS, TOKEN])
    parts = F.when(F.col("text").rlike("[0-9@]"), placed(pieces(F.col("text"), any_part)))
    word = r"([^\x20\x09-\x0D]+)"

    def seed_kind(x: Column, of_kind: Column) -> Column:
        return F.coalesce(*[F.when(over(F.get(of_kind, F.lit(k)), x["s"], x["e"]), k)
                            for k in range(len(KINDS))])

    # Seeds are told here, so that no exploded row has to carry the base spans of its text.
    def of(kind: int) -> Column:
        return F.filter("base", lambda b: b["k"] == kind)

    by_kind = F.array(*map(of, range(len(KINDS))))
    around = lambda of_kind: F.transform(F.col("parts"), lambda x, i: F.struct(
        seed_kind(x, of_kind).alias("seed_k"), x["s"].alias("s"), x["e"].alias("e"), x["hit"].alias("hit"),
        F.regexp_extract(x["gap"], word + r"[\x20\x09-\x0D]*$", 1).alias("left"),
        F.regexp_extract(F.coalesce(F.get(F.col("parts"), i + 1)["gap"], F.lit("")),
                         r"^[\x20\x09-\x0D]*" + word, 1).alias("right")))
    flat = rows.withColumn("parts", parts).select(
        "doc_id", "hash", F.explode(bound(by_kind, around)).alias("x")).filter("x.hit <> ''").select(
        "doc_id", "hash", "x.*")
    opening = r"^(?!\([0-9]+\)[\x20-]?[0-9])[(\['\"<]"  # the bracket of a prefix stays
    lead = F.length(F.regexp_extract("hit", opening + "*", 0))
    bare = F.regexp_replace("hit", opening + r"+|[)\]'\">.,;:!?]+$", "")
    seed = F.col("seed_k")
    token = F.when(seed.isNull(), bare).otherwise(F.col("hit"))
    s = F.when(seed.isNull(), F.col("s") + lead).otherwise(F.col("s"))
    return flat.select(
        "doc_id", "hash", s.cast("int").alias("s"), (s + F.length(token)).cast("int").alias("e"),
        F.lower(token).alias("instance"), F.coalesce(seed, shape(token)).alias("k"),
        seed.isNotNull().alias("seed"),
        F.array(F.concat(F.lit("L|"), F.lower("left")), F.concat(F.lit("R|"), F.lower("right")))
        .alias("patterns")).filter("k is not null")


def accepted(found: DataFrame) -> DataFrame:
    """(instance, k) of the candidates that the rounds accept."""
    edges = stored(found.select(F.explode("patterns").alias("pattern"), "instance", "k", "seed")
                   .filter("length(pattern) > 2").groupBy("pattern", "instance", "k")
                   .agg(F.max("seed").alias("seed")), "edges")
    known = stored(edges.filter("false").select("instance", "k"), "known")
    size = 0
    while True:  # more accepted make more confident: it only grows, up to the instances
        marked = edges.join(known.withColumn("new", F.lit(True)), ["instance", "k"], "left")
        positive = F.col("seed") | F.coalesce("new", F.lit(False))
        stats = marked.groupBy("pattern").agg(
            F.count("*").alias("n"),
            *[F.count_if(positive & (F.col("k") == k)).alias(f"p{k}") for k in range(len(KINDS))])
        confident = stored(stats.select("pattern", "n", F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(f"p{k}").alias("p")) for k in range(len(KINDS))]))
            .alias("x")).select("pattern", "x.k", "x.p", (F.col("x.p") / (F.col("n") + 1)).alias("c"))
            .filter((F.col("p") >= SUPPORT) & (F.col("c") >= CONFIDENCE)).drop("p"), "confident")
        known = stored(edges.filter("not seed").join(confident, ["pattern", "k"])
                       .groupBy("instance", "k")
                       .agg((1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("score"))
                       .filter(F.col("score") >= CONFIDENCE).select("instance", "k"), "known")
        before, size = size, known.count()
        if size == before:
            break
    return known


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) per row: arrays of spans (s start, k kind number, e end)."""
    rows = texts(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("hash"), "text", base_spans(F.col("text")).alias("base"))
    base = rows.select("doc_id", "hash", "base", F.lit(0).alias("part"))
    found = stored(occurrences(rows), "occurrences")
    added = (found.filter("not seed").join(accepted(found), ["instance", "k"])
             .groupBy("doc_id", "hash").agg(F.collect_set(F.struct("s", "k", "e")).alias("added")))
    added = added.select(F.col("doc_id").alias("id"), F.col("hash").alias("h"), "added")
    return base.join(added, base["doc_id"].eqNullSafe(added["id"]) & (base["hash"] == added["h"]),
                     "left").select("doc_id", "base", F.coalesce(
                         "added", F.array().cast(SPANS)).alias("added"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans, their digest, all spans, the number added."""
    kinds = F.transform("base", lambda x: x["k"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(KINDS)]
    return extract(docs).select(
        "doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"))
