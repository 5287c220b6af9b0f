"""Awkward documents that every operator must take."""

import random

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
NAMES = "doc_id long, text string, lang string, source string, n_chars long, row string, hash " \
        "string, key long, x string, uid long, m string, ids string, range int, base string"


def prose(rng, n):
    return " ".join(rng.choice(["river", "stone", "walk", "green", "over", "light", "seven", "door",
                                "paper", "under", "cloud", "north"]) + str(rng.randrange(40))
                    for _ in range(n))


def rows():
    rng = random.Random(4)
    texts = [(i, prose(rng, 60)) for i in range(1, 13)]
    texts += [(20, texts[0][1]), (21, texts[0][1]), (None, texts[1][1]), (None, None), (None, None),
              (30, ""), (31, None), (32, " \n\t "), (40, LONG), (50, "same\nsame\nsame row"),
              (50, "same\nsame\nsame row"), (51, "one"), (52, "éÉ ſKİ \U0001F600 x y")]
    return [(i, t, None, None, None, "r", "h", 1, "x", 2, "m", "i", 3, "b") for i, t in texts]


def frame(spark):
    from tradewind.llm.frames import ship

    ship(spark)
    return spark.createDataFrame(rows(), NAMES).repartition(3)


def ids(found, name="doc_id"):
    return sorted((r[name] for r in found), key=lambda i: (i is None, i))


def all_ids():
    return sorted((r[0] for r in rows()), key=lambda i: (i is None, i))
