"""SpotSigs document fingerprints, in DataFrame functions only.

A signature is a common word (anchor) with the chain of the next ``CHAIN`` content words; anchors inside a chain are
passed over, however many stand in a row. A text's fingerprint is the set of its signatures, shown as one digest. Likeness is
the Jaccard of two sets, pruned by their sizes: nothing is compared where one is empty, and
``near_pairs``, the search for all similar sets, looks only at sets of the same or the next length partition
(borders grow by ``1 / threshold``) that share one of their rarest signatures and whose sizes allow the
threshold.

Edge cases: a null text counts as empty; an empty text has an empty set, like only another empty one;
a text without a full chain has its words as its only signature; repeated rows have equal fingerprints;
a null id comes after all others; a single row is its own next; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

#: Common words of English, French, German and Spanish, and the bar of tables.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the they "
    "this to was we were what which with you "
    "au aux avec dans de des du elle en est et il la le les ne par pas pour que qui se sur un une "
    "auf das dem den der die ein eine er es für ich im ist mit nicht sich sie und von zu "
    "al con del el los las no para se su una y |"
).split()
CHAIN = 2
MARK = "\x01"
#: Documents whose neighbours are looked up together, and pieces of the id range.
RUN = 8192
SEGMENTS = 64


def _any_anchor() -> str:
    """One pattern for all anchors, branching on the first letter."""
    by_first: dict[str, list[str]] = {}
    for word in sorted(set(ANCHORS), key=lambda w: (w[0], -len(w))):
        by_first.setdefault(word[0], []).append(word[1:])
    return "|".join(("\\" if first == "|" else "") + first + "(?:" + "|".join(rest) + ")" for first, rest in by_first.items())


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct hashes of a text's signatures."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\s|]+", "")

    def of_tokens(tokens: Column) -> Column:
        # Content words by place; the chain of an anchor is the words at the next places, so a run of anchors costs its length.
        def chains(content: Column) -> Column:
            def at(token: Column, i: Column) -> Column:
                following = F.array_join(F.slice(content, i + 2, chain), " ")
                anchors = F.slice(F.split(token, MARK, -1), 2, F.char_length(token))
                found = _with(following, lambda f: F.transform(anchors, lambda a: F.xxhash64(F.concat_ws(" ", a, f))))
                return F.when(token.contains(MARK) & (i + chain < F.size(content)), found)

            return F.flatten(F.filter(F.transform(tokens, at), lambda x: x.isNotNull()))

        return _with(F.transform(tokens, lambda t: F.substring_index(t, MARK, 1)), chains)

    def of_words(words: Column) -> Column:
        # Every anchor hangs on the content word before it; one stands before the first word.
        hung = F.regexp_replace(F.concat(F.lit("^ "), words, F.lit(" ")), f" (?:({_any_anchor()}))(?= )", f"{MARK}$1")
        hashed = _with(F.split(F.rtrim(hung), " ", -1), of_tokens)
        whole = F.when(words != "", F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return _with(hashed, lambda found: F.when(F.size(found) > 0, F.sort_array(F.array_distinct(found))).otherwise(whole))

    return _with(F.trim(F.regexp_replace(plain, r"\s+", " ")), of_words)


def digest(found: Column) -> Column:
    return F.sha2(F.array_join(found.cast("array<string>"), ","), 256)


def likeness(one: Column, other: Column) -> Column:
    """Jaccard of two sets; 1 for two empty ones. Where one is empty nothing is compared."""
    both = F.size(F.array_intersect(one, other))
    small, large = F.least(F.size(one), F.size(other)), F.greatest(F.size(one), F.size(other))
    return F.when(large == 0, 1.0).when(small == 0, 0.0).otherwise(both / (small + large - both))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the next row in descending id, the first after the last.

    Ids are cut into runs of about ``RUN`` rows by quantiles; each run also gets the first row of the next
    one, so the texts move once and no run grows with the table.
    """
    lowest = F.lit(-(2**63)).cast("bigint")
    rows = docs.withColumn("place", F.coalesce("doc_id", lowest))
    cuts = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    n, quantiles = rows.agg(F.count("*"), F.percentile_approx("doc_id", cuts, 10_000)).first()
    borders = sorted(set(quantiles or [0]))
    parts = max(1, math.ceil(n / RUN / SEGMENTS))
    run = F.lit(-1).cast("bigint")
    for i, (low, high) in enumerate(zip(borders, borders[1:] or borders, strict=False)):
        inside = F.floor((F.col("doc_id").cast("double") - low) * parts / max(high - low, 1))
        at = F.greatest(F.lit(0), F.least(F.lit(parts - 1), inside)).cast("bigint")
        run = F.when(F.col("doc_id") >= low, F.lit(i * parts) + at).otherwise(run)
    rows = rows.withColumn("run", run)
    order = Window.orderBy(F.desc("run"))
    heads = rows.groupBy("run").agg(F.max("place").alias("place"))
    before = F.coalesce(F.lag("run").over(order), F.min("run").over(Window.partitionBy()))
    heads = stored(heads.select("place", before.alias("run")).coalesce(1), "run-heads")
    guests = rows.drop("run").join(heads, "place").withColumn("guest", F.lit(True))
    whole = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    # A guest follows its hosts, also where the only run hosts its own first row.
    in_run = Window.partitionBy("run").orderBy("guest", F.desc("place"), "text")
    return whole.withColumn("next_text", F.lead("text").over(in_run)).where(~F.col("guest")).select("doc_id", "text", "next_text")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``next_text``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pairs = with_next(rows).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sets = pairs.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("own"),
        signatures(F.col("edited")).alias("changed"),
        signatures(F.col("next_text")).alias("following"),
    )
    return sets.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digest(F.col("own")).alias("fingerprint"),
        digest(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.size("own").cast("bigint").alias("n_signatures"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): doc_id and node of each document with signatures, and all pairs of nodes as like as ``threshold``.

    A node is one distinct set, named by its smallest id, so copies are not paired. Two sets of Jaccard t share a signature among
    the first ``n - ceil(t * n) + 1`` of each, rarest first, and their lengths differ by a factor of
    ``1 / t`` at most: a set is posted in its own length partition and looks into its own and the next one. A pair is
    compared once, at its first shared signature. ``threshold`` is above 0.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), signatures(F.col(text_col)).alias("set"))
    rows = stored(rows.where(F.size("set") > 0), "spots")
    members = rows.groupBy("set").agg(F.min("doc_id").alias("node"))
    nodes = stored(members, "spot-nodes")
    every = nodes.select("node", F.explode("set").alias("signature"))
    ranks = every.groupBy("signature").agg(F.count("*").alias("n"))
    ordered = every.join(ranks, "signature").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "signature"))).alias("ordered"))
    size = F.size("ordered")
    keep = size - F.ceil(size * F.lit(threshold) - 1e-9) + 1
    part = F.floor(F.log(size.cast("double")) / math.log(1 / threshold) + 1e-9).cast("int") if threshold < 1 else size
    posts = ordered.select(
        "node",
        size.alias("size"),
        part.alias("part"),
        F.transform("ordered", lambda x: x["signature"]).alias("spots"),
        F.slice(F.transform("ordered", lambda x: x["signature"]), 1, keep.cast("int")).alias("lead"),
    )
    look = posts.withColumn("at", F.explode(F.array("part", F.col("part") + 1)))
    a = look.select("*", F.explode("lead").alias("signature")).select(
        F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("part").alias("part_a"), F.col("spots").alias("spots_a"), F.col("lead").alias("lead_a"), "at", "signature"
    )
    b = posts.select(
        F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("spots").alias("spots_b"), F.col("lead").alias("lead_b"), F.col("part").alias("at"), F.explode("lead").alias("signature")
    )
    once = (F.col("part_a") < F.col("at")) | (F.col("a") < F.col("b"))
    smaller, larger = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    allowed = smaller >= larger * threshold - 1e-9
    first = F.get(F.array_intersect("lead_a", "lead_b"), F.lit(0)) == F.col("signature")
    met = a.join(b, ["signature", "at"]).where(once & allowed & first)
    near = likeness(F.col("spots_a"), F.col("spots_b"))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), near.alias("likeness")).where(F.col("likeness") >= threshold - 1e-12)
    return rows.join(nodes, "set").select("doc_id", "node"), pairs
