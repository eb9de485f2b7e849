"""Exact top-k search in Hamming distance by incremental multi-index hashing.

A vector's code is one bit per number (set if above zero), cut into segments of about log2(n) bits. Equal
codes are one entry with their ``k + 1`` smallest ids, and equal queries one query. Round ``r`` looks up, in
every segment, the values at distance ``r`` from the query's own. After it every code within
``m * (r + 1) - 1`` has been met (one of its ``m`` segments is within ``r``), so a query whose k-th verified
distance is no larger is finished, ties included; the others go on. A pair is verified in one place only:
the first segment at the pair's least segment distance.

The index, one row per code and segment, is written once, hashed by segment value, and stays where it is: a round moves
only its probes. Values that more than ``FREQUENT`` codes share are cut into shares, each a key of its own, which probes
of that value look up one by one.

Edge cases: a null or empty vector has no code, is never found and finds nothing; null or not-a-number
elements count as unset; shorter vectors are padded with unset bits; ties go to the smaller id; repeated rows
are neighbours at distance 0 (a row never finds its own id); fewer than k other rows give fewer; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored
from shelfwise.operators.pairing import parts
from shelfwise.session import run_dir
from shelfwise.sources.tables import save_bucketed

K = 10
#: Bits of a segment; they grow with the table up to what a number holds.
MIN_BITS, MAX_BITS = 4, 30
#: Codes of one segment value that are one key.
FREQUENT = 10_000
SHARES = 2**20
EVERY = 100


def code(vector: Column, dims: int, bits: int) -> Column:
    """Array of segment values."""
    padded = F.concat(vector.cast("array<double>"), F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), dims - F.size(vector))))
    bit = lambda x: F.when(F.coalesce(x, F.lit(0.0)) > 0, F.when(F.isnan(x), 0).otherwise(1)).otherwise(0)
    value = lambda part: F.aggregate(part, F.lit(0), lambda sum_, x: sum_ * 2 + bit(x))
    return F.array(*[value(F.slice(padded, at + 1, min(bits, dims - at))) for at in range(0, dims, bits)])


def _probes(open_: DataFrame, bits: int, radius: int) -> DataFrame:
    """query, worst, segment, value: every value at distance ``radius`` from each of the query's own. Bits are flipped one after
    the other in rising order, so just those values are made."""
    rows = open_.select("query", "worst", F.posexplode("query").alias("segment", "value")).withColumn("next", F.lit(0))
    for flipped in range(radius):
        # Room is left for the bits still to be flipped.
        last = bits - radius + flipped
        rows = rows.where(F.col("next") <= last).withColumn("bit", F.explode(F.sequence(F.col("next"), F.lit(last))))
        rows = rows.select("query", "worst", "segment", F.expr("value ^ shiftleft(1, bit)").alias("value"), (F.col("bit") + 1).alias("next"))
    return rows.drop("next")


def _spot(bits: int) -> Column:
    """Segment and value as one number."""
    return F.col("segment").cast("bigint") * 2**bits + F.col("value")


def _apart(n: int) -> Column:
    """Distance in each segment of ``code`` and ``query``."""
    return F.array(*[F.bit_count(F.col("code")[i].bitwiseXOR(F.col("query")[i])) for i in range(n)])


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, queries: Column | None = None
) -> DataFrame:
    """query_id, rank, neighbour_id, distance. Queries are the rows whose id is a multiple of ``EVERY``, if not given."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector")).where(
        F.col("id").isNotNull() & (F.size("vector") > 0)
    )
    n, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    bits = min(MAX_BITS, max(MIN_BITS, round(math.log2(max(n, 2)))), dims)
    m = -(-dims // bits)
    coded = stored(rows.select("id", code(F.col("vector"), dims, bits).alias("code")), "codes")

    by_id = Window.partitionBy("code").orderBy("id")
    few = coded.distinct().withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    entries = stored(few.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    posted = entries.select("code", "ids", F.posexplode("code").alias("segment", "value")).withColumn("spot", _spot(bits)).drop("segment", "value")
    often = posted.groupBy("spot").agg(F.ceil(F.count("*") / FREQUENT).alias("shares")).where("shares > 1")
    often = stored(often.select("spot", "shares"), "frequent")
    shares = F.coalesce("shares", F.lit(1))
    mine = posted.join(often, "spot", "left").select(
        "code", "ids", (F.col("spot") * SHARES + F.pmod(F.xxhash64("code"), shares)).alias("place")
    )
    spark = vectors.sparkSession
    index = save_bucketed(mine, run_dir(spark, "segment-index"), "place", parts(spark))

    asked = coded.where((F.col("id") % EVERY == 0) if queries is None else queries)
    open_ = stored(asked.select(F.col("code").alias("query")).distinct().withColumn("worst", F.lit(m * bits)), "open")
    best, done = None, []
    for radius in range(bits + 1):
        # The table of open queries is small beside what it is exploded to: dealt out first.
        probes = _probes(open_.repartition(parts(spark)), bits, radius).withColumn("spot", _spot(bits)).drop("value").join(often, "spot", "left")
        share = F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)).alias("share")
        probes = probes.select("query", "worst", "segment", "spot", share).withColumn("place", F.col("spot") * SHARES + F.col("share"))
        apart = _apart(m)
        distance = F.aggregate(apart, F.lit(0), lambda a, b: a + b)
        first = (F.array_min(apart) == radius) & (F.array_position(apart, F.lit(radius)) == F.col("segment") + 1)
        # Probes are far more than the stored table that they are exploded from, which is all that Spark sees: never broadcast.
        met = probes.hint("merge").join(index.hint("merge"), "place").where(first & (distance <= F.col("worst")))
        fresh = met.select("query", distance.alias("distance"), F.explode("ids").alias("id"))
        if best is not None:
            fresh = fresh.unionByName(best.join(open_.select("query"), "query", "left_semi").select("query", "distance", "id"))
        nearest = Window.partitionBy("query").orderBy("distance", "id")
        best = stored(fresh.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1), "best")
        reach = m * (radius + 1) - 1
        kth = best.where(F.col("place") == k + 1).select("query", F.col("distance").alias("kth"))
        state = open_.join(kth, "query", "left").withColumn("over", F.coalesce(F.col("kth") <= reach, F.lit(False)))
        over = state.where("over").select("query") if radius < bits else state.select("query")
        done.append(best.join(over, "query", "left_semi").select("query", "distance", "id"))
        open_ = stored(state.where(~F.col("over")).select("query", F.coalesce("kth", "worst").alias("worst")), "open")
        if radius < bits and open_.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    lists = found.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        asked.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
        .distinct()
        .join(lists, "query")
        .select("query_id", F.posexplode(others).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("neighbour_id"), F.col("x.distance").alias("distance"))
    )
