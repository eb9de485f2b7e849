"""Mixing sources to target weights by a low-discrepancy schedule.

Every source has a target number of words (its weight's share, at most ``passes`` times what it
holds). The schedule is a sequence of slots. Slot ``i`` takes the golden-ratio point ``frac(i * phi)``,
which falls into one source's stretch of the cumulative targets; its rank is the number of that
source's earlier slots. A source's documents, shuffled by a hash, lie on one line of words that
repeats as often as needed, cut into blocks of ``block_words`` words. The slot of rank ``r`` takes
block ``r``, so any prefix of the schedule holds the sources in proportion, and a source ends
exactly at its target (its last block is cut there).

Edge cases: a null or empty text has size 0 and is never taken; a null source is a source of its own,
ordered last; repeated rows are separate rows; an empty table gives an empty mix; other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import n_words, stored

WEIGHTS = (5, 2, 1)
PASSES = 3
BLOCK_WORDS = 128
SEED = "mix"
#: The golden-ratio lattice in whole numbers: point i is (i * STEP mod POINTS) / POINTS.
POINTS = 2**31
STEP = 1327217885
#: Hash parts of a source's line, and slots that are ranked together.
LINE_PARTS = 4096
SLOT_RUN = 65536


def source_key(source: Column) -> Column:
    """Text that sorts as the source does by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, skey, size (words), turn (shuffle key) of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        source_key(F.col(source_col)).alias("skey"),
        n_words(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":" + SEED)).cast("binary")).alias("turn"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """skey, source_size, target, need (target in whole words), below (targets of earlier sources).

    One row per source. Sources in order of the level at which they are exhausted: those before the
    first that outlasts the common level stop at ``passes`` times their size, the rest share what is
    left by weight.
    """
    by_name = Window.orderBy("skey")
    before = Window.orderBy("full_at", "skey").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    level = (
        per.withColumn("weight", weight)
        .withColumn("full_at", F.col("source_size") * float(passes) / F.col("weight"))
        .withColumn(
            "level",
            (F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * passes).over(before), F.lit(0)))
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        )
    )
    outlasts = F.when(F.col("full_at") > F.col("level"), F.col("level"))
    shared = level.withColumn("common", F.min_by(outlasts, F.when(outlasts.isNotNull(), F.col("full_at"))).over(whole))
    upto = (F.col("source_size") * passes).cast("double")
    return (
        shared.withColumn("target", F.coalesce(F.least(upto, F.col("common") * F.col("weight")), upto))
        .withColumn("need", F.floor(F.col("target") + 0.5).cast("bigint"))
        .withColumn("below", F.coalesce(F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .select("skey", "source_size", "target", "need", "below")
    )


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, skey, rank: which block of which source comes at each place of the mix."""
    spark = goals.sparkSession
    total, n_sources = goals.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.count("*")).first()
    n_slots = -(-int(total) // block_words)
    n_bins = 1024 + 4 * n_sources
    scale = POINTS / max(total, 1.0)
    stretch = goals.where(F.col("target") > 0).select(
        "skey", (F.col("below") * scale).alias("lo"), ((F.col("below") + F.col("target")) * scale).alias("hi")
    )
    bin_of = lambda c: F.floor(c * n_bins / POINTS)
    binned = stretch.select("*", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))).alias("bin"))
    points = spark.range(n_slots).select(
        F.col("id").alias("slot"), ((F.col("id") % POINTS) * STEP % POINTS).alias("point")
    )
    hits = (
        points.withColumn("bin", bin_of(F.col("point")))
        .join(binned, "bin")
        .where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
        .select("slot", "skey", F.floor(F.col("slot") / SLOT_RUN).alias("run"))
    )
    runs = hits.groupBy("skey", "run").count()
    offsets = runs.select(
        "skey",
        "run",
        F.coalesce(
            F.sum("count").over(Window.partitionBy("skey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("offset"),
    )
    in_run = F.row_number().over(Window.partitionBy("skey", "run").orderBy("slot")) - 1
    ranked = (
        hits.withColumn("place", in_run)
        .join(offsets, ["skey", "run"])
        .select("slot", "skey", (F.col("offset") + F.col("place")).cast("bigint").alias("rank"))
    )
    blocks = F.ceil(F.col("need") / block_words).cast("bigint")
    quota = goals.select("skey", blocks.alias("blocks"))
    within = ranked.join(quota, "skey").where(F.col("rank") < F.col("blocks")).drop("blocks")
    # A source that the points gave too few slots (their discrepancy, a handful) gets the rest at the end.
    missing = (
        quota.join(runs.groupBy("skey").agg(F.sum("count").alias("got")), "skey", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .where(F.col("got") < F.col("blocks"))
        .select("skey", F.explode(F.sequence(F.col("got"), F.col("blocks") - 1)).alias("rank"))
        .select((F.lit(n_slots) + F.col("rank")).alias("slot"), "skey", "rank")
    )
    return within.unionByName(missing)


def on_line(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """sizes with start: the place of a row's first word on its source's shuffled line."""
    part = F.conv(F.substring("turn", 1, 3), 16, 10).cast("int") % LINE_PARTS
    rows = sizes.withColumn("part", part)
    parts = rows.groupBy("skey", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("skey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("skey", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    in_part = Window.partitionBy("skey", "part").orderBy("turn", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("ahead", F.coalesce(F.sum("size").over(in_part), F.lit(0)))
        .join(offsets, ["skey", "part"])
        .join(goals.select("skey", "source_size", "target", "need"), "skey")
        .select("doc_id", "skey", "size", (F.col("offset") + F.col("ahead")).alias("start"), "source_size", "target", "need")
    )


def pieces(line: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: slot, doc_id, skey, start, from_word, words, in the order of slot and from_word.

    A document is cut at block borders; each piece goes where its block's slot is.
    """
    again = (
        line.where((F.col("size") > 0) & (F.col("start") < F.col("need")))
        .withColumn("pass", F.explode(F.expr("sequence(0L, (need - 1 - start) div source_size)")))
        .withColumn("lo", F.col("start") + F.col("pass") * F.col("source_size"))
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("need")))
    )
    cut = again.withColumn("rank", F.explode(F.expr(f"sequence(lo div {block_words}L, (hi - 1) div {block_words}L)"))).select(
        "doc_id",
        "skey",
        "start",
        "rank",
        (F.greatest("lo", F.col("rank") * block_words) - F.col("lo")).alias("from_word"),
        (F.least("hi", (F.col("rank") + 1) * block_words) - F.greatest("lo", F.col("rank") * block_words)).alias("words"),
    )
    return cut.join(slots, ["skey", "rank"]).select("slot", "doc_id", "skey", "start", "from_word", "words")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, block_words: int = BLOCK_WORDS, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(line, pieces) of the whole mix. ``columns``: id_col, text_col, source_col."""
    sizes = stored(sized(docs, **columns), "mix-sizes")
    goals = stored(targets(sizes, weights, passes).coalesce(1), "mix-targets")
    line = on_line(sizes, goals)
    return line, pieces(line, schedule(goals, block_words), block_words)


def taken(line: DataFrame, mixed: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    got = mixed.groupBy("skey", "start").agg(F.sum("words").alias("taken"))
    # Rows without words share a start with the next row and get nothing.
    some = line.where(F.col("size") > 0).join(got, ["skey", "start"], "left")
    none = line.where(F.col("size") == 0).withColumn("taken", F.lit(None).cast("bigint"))
    return some.unionByName(none).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )
