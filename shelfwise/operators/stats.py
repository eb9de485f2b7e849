"""Popularity and average-score statistics over ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as fn

MONTH = "yyyyMM"
#: Scores are added as decimals, so that totals do not depend on the order and can be taken back.
EXACT = "decimal(38,9)"


def most_rated(ratings: DataFrame) -> DataFrame:
    """productId, count - most rated first."""
    counts = ratings.groupBy("productId").agg(F.count("productId").alias("count"))
    return counts.orderBy(F.desc("count"), "productId")


def most_rated_by_period(ratings: DataFrame, pattern: str = "yyyyMM") -> DataFrame:
    """productId, count, yearmonth - newest period first, most rated first inside it."""
    bucketed = ratings.select("productId", fn.time_bucket("timestamp", pattern).alias("yearmonth"))
    counts = bucketed.groupBy("yearmonth", "productId").agg(F.count("productId").alias("count"))
    return counts.select("productId", "count", "yearmonth").orderBy(
        F.desc("yearmonth"), F.desc("count"), "productId"
    )


def average_scores(ratings: DataFrame) -> DataFrame:
    """productId, avg - best first; averages equal to nine decimals rank by product."""
    means = ratings.groupBy("productId").agg(F.avg("score").alias("avg"))
    return means.orderBy(F.desc(F.round("avg", 9)), "productId")


def totals(ratings: DataFrame) -> DataFrame:
    """productId, month, n, total: what the statistics are made of.  Totals of parts add up to those of the whole."""
    return ratings.groupBy("productId", fn.time_bucket("timestamp", MONTH).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("score").cast(EXACT)).alias("total")
    )


def change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Totals that turn those of ``before`` into those of ``after``; rows without a change are left out."""
    less = totals(before).select("productId", "month", (-F.col("n")).alias("n"), (-F.col("total")).alias("total"))
    return merged(totals(after).unionByName(less), whole=False)


def merged(parts: DataFrame, whole: bool = True) -> DataFrame:
    """Totals added up by product and month."""
    added = parts.groupBy("productId", "month").agg(
        F.sum("n").cast("bigint").alias("n"), F.sum("total").cast(EXACT).alias("total")
    )
    return added.where("n <> 0" if whole else "n <> 0 OR total <> 0")


def most_rated_of(known: DataFrame) -> DataFrame:
    """``most_rated`` from totals."""
    counts = known.groupBy("productId").agg(F.sum("n").alias("count"))
    return counts.orderBy(F.desc("count"), "productId")


def most_rated_by_month_of(known: DataFrame) -> DataFrame:
    """``most_rated_by_period`` from totals."""
    return known.select("productId", F.col("n").alias("count"), F.col("month").alias("yearmonth")).orderBy(
        F.desc("yearmonth"), F.desc("count"), "productId"
    )


def average_scores_of(known: DataFrame) -> DataFrame:
    """``average_scores`` from totals."""
    sums = known.groupBy("productId").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    means = sums.select("productId", (F.col("total").cast("double") / F.col("n")).alias("avg"))
    return means.orderBy(F.desc(F.round("avg", 9)), "productId")


def top_n(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.limit(n)


def distinct_ids(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All users and all products that occur in the ratings."""
    return ratings.select("userId").distinct(), ratings.select("productId").distinct()
