"""Links between documents that share a key, in number proportional to the occurrences.

Instead of all pairs within a key's documents, each document is linked to the nearest
earlier one with that key. A key with more than `SPREAD` documents is dealt into parts by
a hash of the document, their number a power of two: the parts of keys of unequal numbers
nest, so that keys with the same holders in a part agree on the partner. The first of each
part is linked to the key's first document. Where two keys must point to one partner, their
users make a key of both: one link then proves the overlap. So
no key is ever gathered in one task, every holder but the first has an earlier partner,
and a document is the partner of few others for each of its keys. On request, keys with few
holders link all of their pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.frames import stored

SPREAD = 256


def linked(occurrences: DataFrame, spread: int = SPREAD, few: int = 2) -> DataFrame:
    """From (key, doc, at), each key and doc once, where doc is any ordered type and at goes
    along: (key, n, doc, at, partner, partner_at), n being the documents with the key. A key
    with up to `few` documents links each of them to every earlier one. Where n is known it may
    be a column; only keys of several parts are then counted."""
    place = F.struct("doc", "at")
    many = occurrences.filter(F.col("n") > spread) if "n" in occurrences.columns else occurrences
    stats = stored(many.groupBy("key").agg(
        F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1"), "shared")
    shared = many.drop("n").join(stats, "key").withColumn("part", F.when(F.col("n") > spread, F.pmod(
        F.xxhash64("doc"), F.pow(F.lit(2), F.ceil(F.log2(F.col("n") / spread))).cast("long")))
        .otherwise(0))
    if "n" in occurrences.columns:  # a key in one part needs no first holder: its first has no partner
        none = F.lit(None).cast(occurrences.select(place.alias("x")).schema["x"].dataType)
        shared = shared.unionByName(occurrences.filter(F.col("n") <= spread).select(
            "*", none.alias("first"), F.lit(0).cast("long").alias("part")))
    # The join leaves all parts of a key together; a window alone would not part them.
    shared = shared.repartition("key", "part")
    order = Window.partitionBy("key", "part").orderBy("doc")
    near = F.coalesce(F.lag(F.struct("doc", "at")).over(order), F.col("first"))
    if few > 2:
        earlier = F.collect_list(F.struct("doc", "at")).over(order.rowsBetween(1 - few, -1))
        near = F.when((F.col("n") <= few) & (F.size(earlier) > 0), earlier).otherwise(F.array(near))
        shared = shared.withColumn("all", near)
        near = F.explode("all")
    return (shared.withColumn("near", near).filter("near.doc <> doc")
            .select("key", "n", "doc", "at", F.col("near.doc").alias("partner"),
                    F.col("near.at").alias("partner_at")))
