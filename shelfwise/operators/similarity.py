"""Threshold similarity, kept as groups of equal items plus group pairs.

Items with the same vector are one group, and similarity is stored between groups.
That loses nothing - every product pair follows from the two memberships - and a
million copies of one product cost one group instead of 10^12 pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators import pairing, recs, text
from shelfwise.session import run_dir

SLACK = 1e-9
CHUNK = 512
# Scores equal to this many decimals rank by product id.
RANK_DIGITS = 9
ID_BLOCK = 65_536


class Similarity(NamedTuple):
    members: DataFrame  # productId, grp (the smallest productId of the group)
    pairs: DataFrame  # grp, simGrp, score (both directions; grp = simGrp when a group has copies)


def from_pairs(pairs: DataFrame) -> Similarity:
    """A plain (productId, simProductId, score) table as a Similarity of one-item groups."""
    ids = pairs.select(F.explode(F.array("productId", "simProductId")).alias("productId")).distinct()
    return Similarity(
        ids.select("productId", F.col("productId").alias("grp")),
        pairs.select(F.col("productId").alias("grp"), F.col("simProductId").alias("simGrp"), "score"),
    )


def to_pairs(sim: Similarity) -> DataFrame:
    """productId, simProductId, score for every product pair - as large as that table is by definition."""
    a = sim.members
    b = sim.members.select(F.col("productId").alias("simProductId"), F.col("grp").alias("simGrp"))
    return (
        a.join(sim.pairs, "grp")
        .join(b, "simGrp")
        .where(F.col("productId") != F.col("simProductId"))
        .select("productId", "simProductId", "score")
    )


def content_similarity(products: DataFrame, threshold: float = 0.4) -> Similarity:
    """Products whose tag TF-IDF cosine exceeds the threshold."""
    return Similarity(
        text.group_members(products), profile_pairs(text.profile_vectors(products), threshold)
    )


def hashed_content_similarity(products: DataFrame, threshold: float = 0.4) -> Similarity:
    """The same over hashed words: words that share a bucket count as one."""
    return Similarity(
        text.group_members(products), profile_pairs(text.hashed_vectors(products), threshold)
    )


def bucket_content_similarity(
    products: DataFrame, bucket: Callable[[Column], Column], threshold: float = 0.4
) -> Similarity:
    """The same with a bucket function of the caller's."""
    return Similarity(
        text.group_members(products), profile_pairs(text.bucket_vectors(products, bucket), threshold)
    )


def profile_pairs(vectors: DataFrame, threshold: float) -> DataFrame:
    """grp, simGrp, score over unit sparse vectors; exact for any threshold >= 0.

    Two vectors above the threshold share a word, and the rarest shared word lies where
    the rest of either vector (that word included) is still longer than the threshold.
    Only those leading words are joined on; each pair is met at its rarest shared
    word and nowhere else, and the bound on the remaining product
    drops most pairs before their cosine is computed.
    """
    cut = threshold * (1 - SLACK)
    # Length of the rest from each place on: one running sum from the last entry to the first.
    running = F.aggregate(
        F.reverse("entries"),
        F.array(F.lit(0.0)),
        lambda acc, e: F.concat(F.array(F.get(acc, F.lit(0)) + e["w"] * e["w"]), acc),
    )
    tails = F.transform(F.slice(running, 1, F.size("entries")), lambda x: F.sqrt(x))
    heads = (
        vectors.withColumn("tails", tails)
        .select("grp", "entries", "tails", F.posexplode("entries").alias("pos", "e"))
        .where(F.get("tails", F.col("pos")) > cut)
    )
    posted = heads.select(
        F.col("e.term").alias("term"),
        F.col("e.w").alias("w"),
        F.coalesce(F.get("tails", F.col("pos") + 1), F.lit(0.0)).alias("rest"),
        "grp",
        F.transform(F.slice("entries", 1, F.col("pos")), lambda e: e["term"]).alias("before"),
        F.slice("entries", F.col("pos") + 2, F.size("entries")).alias("after"),
        pairing.chunk_count(F.col("e.listed"), CHUNK).alias("chunks"),
    ).withColumn("chunk", pairing.chunk_of(F.col("grp"), F.col("chunks")))
    left, right = pairing.chunk_pair_sides(posted, "chunk", "chunks")
    a = pairing.spread(left, "term", "lo", "hi").select(
        "term", "lo", "hi", F.col("grp").alias("p1"), F.col("w").alias("w1"),
        F.col("rest").alias("rest1"), F.col("before").alias("before1"),
        F.transform("after", lambda e: F.struct(e["term"].alias("term"), e["w"].alias("w"))).alias("after1"),
    )
    b = right.select(
        "term", "lo", "hi", F.col("grp").alias("p2"), F.col("w").alias("w2"),
        F.col("rest").alias("rest2"), F.col("before").alias("before2"),
        F.map_from_entries(
            F.transform("after", lambda e: F.struct(e["term"], e["w"]))
        ).alias("after2"),
    )
    met = (
        a.join(b, ["term", "lo", "hi"])
        .where(pairing.once("p1", "p2"))
        .where(F.col("w1") * F.col("w2") + F.col("rest1") * F.col("rest2") > cut)
        .where(~F.arrays_overlap("before1", "before2"))
    )
    score = F.aggregate(
        "after1",
        F.col("w1") * F.col("w2"),
        lambda acc, e: acc + e["w"] * F.coalesce(F.try_element_at(F.col("after2"), e["term"]), F.lit(0.0)),
    )
    triangle = met.select("p1", "p2", score.alias("score")).where(F.col("score") > threshold)
    return both_directions(triangle).unionByName(copies(vectors, "grp", threshold))


def both_directions(triangle: DataFrame) -> DataFrame:
    """p1, p2, score -> grp, simGrp, score in both orders."""
    return triangle.select(
        F.inline(
            F.array(
                F.struct(F.col("p1").alias("grp"), F.col("p2").alias("simGrp")),
                F.struct(F.col("p2").alias("grp"), F.col("p1").alias("simGrp")),
            )
        ),
        "score",
    )


def copies(groups: DataFrame, key: str, threshold: float) -> DataFrame:
    """A group of several items is similar to itself with cosine 1."""
    several = groups.where((F.col("members") > 1) & F.lit(threshold < 1.0))
    return several.select(F.col(key).alias("grp"), F.col(key).alias("simGrp"), F.lit(1.0).alias("score"))


def ranked_members(members: DataFrame) -> DataFrame:
    """grp, productId, place, level: items of a group in id order, ``level`` = floor(log2(place)).

    A group may hold a third of all items, so places are not taken from one sort:
    ids are cut into fixed ranges, each range is numbered on its own, and the counts of
    earlier ranges are added.
    """
    blocked = members.withColumn("block", F.floor(F.col("productId") / F.lit(ID_BLOCK)))
    sizes = blocked.groupBy("grp", "block").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("grp", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("grp", "block").orderBy("productId")
    return (
        blocked.withColumn("within", F.row_number().over(inside))
        .join(offsets, ["grp", "block"])
        .select("grp", "productId", (F.col("offset") + F.col("within")).alias("place"))
        .withColumn("level", F.floor(F.log2("place") + SLACK).cast("int"))
    )


def nearest(sim: Similarity, asked: DataFrame, key: list[str], most: int | None = None) -> DataFrame:
    """key..., simProductId, simGrp, score: the ``need`` best items of each asked group, or a few more.

    ``asked`` has the key columns, grp and ``need``.  Items of the asked group itself count too when it has
    copies.  ``most`` says that no need is larger; without it the pairs are first reduced to the
    groups that are asked for.

    An item is beaten by every item of better-graded groups, by the first item of each group of its own grade
    that starts with a smaller id, and by the smaller ids of its own group.  Only items beaten by fewer than
    ``need`` of those are read, so neither many ties nor a group with a third of all items widens the
    result.  They are found by power-of-two level of their place, so a row with a small
    need never meets the bulk of a large group.
    """
    sizes = sim.members.groupBy(F.col("grp").alias("simGrp")).agg(F.count(F.lit(1)).alias("size"))
    # Every group holds an item and so beats all that come later: no more groups than items are needed.
    # With one limit for all, each task cuts to it before the shuffle.
    first = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("grade"), "simGrp"))
    graded = sim.pairs.withColumn("grade", F.round("score", RANK_DIGITS))
    if most:
        graded = graded.withColumn("place", first).where(F.col("place") <= most)
    else:
        largest = asked.groupBy("grp").agg(F.max("need").alias("limit"))
        graded = graded.join(largest, "grp").withColumn("place", first).where(F.col("place") <= F.col("limit"))
    graded = graded.select("grp", "simGrp", "score", "grade").join(sizes, "simGrp")
    grades = Window.partitionBy("grp").orderBy(F.desc("grade"))
    tied = Window.partitionBy("grp", "grade").orderBy("simGrp")
    whole = Window.partitionBy("grp", "grade")
    reach = graded.select(
        "grp", "simGrp", "score", "size",
        (
            F.sum("size").over(grades.rangeBetween(Window.unboundedPreceding, Window.currentRow))
            - F.sum("size").over(whole)
            + F.row_number().over(tied)
            - 1
        ).alias("beaten"),
    )
    if most:
        reach = reach.where(F.col("beaten") < most)
    wanted = (
        asked.join(reach, "grp")
        .where(F.col("beaten") < F.col("need"))
        .withColumn("last", F.least(F.col("need") - F.col("beaten"), F.col("size")))
        .select(
            *key, "score", "last", F.col("simGrp").alias("grp"),
            F.explode(F.sequence(F.lit(0), F.floor(F.log2("last") + SLACK).cast("int"))).alias("level"),
        )
    )
    items = ranked_members(sim.members).withColumnRenamed("productId", "simProductId")
    if most:
        items = items.where(F.col("place") <= most)
    return (
        wanted.join(items, ["grp", "level"])
        .where(F.col("place") <= F.col("last"))
        .select(*key, "simProductId", F.col("grp").alias("simGrp"), "score")
    )


def top_similar(sim: Similarity, asked: DataFrame, k: int) -> DataFrame:
    """productId, simProductId, score, rank: the k best of every asked product.

    One list of k + 1 items is made per group and handed to its members, each of which leaves itself out.
    """
    owners = asked.select("productId").distinct().join(sim.members, "productId")
    groups = owners.select("grp").distinct().select("grp", F.lit(k + 1).alias("need"), F.col("grp").alias("owner"))
    found = nearest(sim, groups, ["owner"], k + 1)
    order = Window.partitionBy("owner").orderBy(F.round("score", RANK_DIGITS).desc(), "simProductId")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    entry = F.struct("rank", "simProductId", "score")
    lists = best.groupBy(F.col("owner").alias("grp")).agg(F.sort_array(F.collect_list(entry)).alias("items"))
    others = F.slice(F.filter("items", lambda i: i["simProductId"] != F.col("productId")), 1, k)
    return (
        owners.join(lists, "grp")
        .select("productId", F.posexplode(others).alias("pos", "i"))
        .select(
            "productId", F.col("i.simProductId").alias("simProductId"), F.col("i.score").alias("score"),
            (F.col("pos") + 1).alias("rank"),
        )
    )


def ranked_groups(sim: Similarity, k: int | None = None) -> DataFrame:
    """grp, rank, simGrp, score: all similar groups of every group, best first, or the first k.

    With ``members`` this holds every product's whole ranked list; copies of a product share one.  Whole lists are
    ranked over all tasks, since one group may be like a third of all others.
    """
    best_first = [F.round("score", RANK_DIGITS).desc(), F.col("simGrp")]
    if k is None:
        rows = recs.whole_ranks(sim.pairs, "grp", best_first, run_dir(sim.pairs.sparkSession, "ranked-pairs"))
    else:
        order = Window.partitionBy("grp").orderBy(*best_first)
        rows = sim.pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return rows.select("grp", "rank", "simGrp", "score")


def stored(sim: Similarity, path: str) -> Similarity:
    """Writes both parts below ``path`` (shared storage) and reads them back, for use in several plans."""
    spark = sim.pairs.sparkSession
    for name, part in zip(sim._fields, sim):
        part.write.mode("overwrite").parquet(f"{path}/{name}")
    return Similarity(*(spark.read.schema(part.schema).parquet(f"{path}/{name}") for name, part in zip(sim._fields, sim)))
