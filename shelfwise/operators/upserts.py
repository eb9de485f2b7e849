"""Keyed updates of ratings and user accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as fn

PAIR = ["userId", "productId"]


def from_requests(requests: DataFrame) -> DataFrame:
    """Form posts (ten-point ``uiScore``, seconds or milliseconds) -> ratings."""
    return requests.select(
        *PAIR, fn.half_score("uiScore").alias("score"), fn.epoch_seconds("timestamp").alias("timestamp")
    )


def upsert_ratings(base: DataFrame, updates: DataFrame) -> DataFrame:
    """One rating per (user, product): the newest update's score, the time the rating first had.

    Repeated base rows of a pair fold to the newest.  Plain aggregates, so a pair that is
    repeated without end is folded before the shuffle.
    """
    columns = [*PAIR, "score", "timestamp"]
    both = base.select(*columns, F.lit(False).alias("new")).unionByName(
        updates.select(*columns, F.lit(True).alias("new"))
    )
    newest = F.struct("timestamp", "score")
    folded = both.groupBy(*PAIR).agg(
        F.max(F.when(F.col("new"), newest)).alias("update"),
        F.max(F.when(~F.col("new"), newest)).alias("stored"),
        F.min(F.when(F.col("new"), F.col("timestamp"))).alias("inserted"),
    )
    return folded.select(
        *PAIR,
        F.coalesce("update.score", "stored.score").alias("score"),
        F.coalesce("stored.timestamp", "inserted").alias("timestamp"),
    )


def named_rows(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows of ``base`` whose pair (user, product) ``updates`` name."""
    return base.join(updates.select(*PAIR).distinct(), PAIR, "left_semi")


def other_rows(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows of ``base`` that ``updates`` leave as they are."""
    return base.join(updates.select(*PAIR).distinct(), PAIR, "left_anti").select(*PAIR, "score", "timestamp")


def replace_pairs(base: DataFrame, updates: DataFrame) -> DataFrame:
    """``base`` with the pairs (user, product) that ``updates`` name as ``upsert_ratings`` leaves them; other rows stay as they are."""
    return other_rows(base, updates).unionByName(upsert_ratings(named_rows(base, updates), updates))


def already_rated(requests: DataFrame, ratings: DataFrame) -> DataFrame:
    """Requests with ``known``: whether their (user, product) is rated already."""
    rated = ratings.select(*PAIR).distinct().withColumn("known", F.lit(True))
    return requests.join(rated, PAIR, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def rating_log(ratings: DataFrame) -> DataFrame:
    """value: the log lines that announce accepted ratings."""
    return ratings.select(fn.log_line("userId", "productId", "score", "timestamp").alias("value"))


def update_preferences(users: DataFrame, changes: DataFrame) -> DataFrame:
    """Sets ``first`` and ``prefGenres`` of the users named in ``changes``; the rest stays."""
    new = changes.select(
        "userId", F.col("first").alias("newFirst"), F.col("prefGenres").alias("newGenres")
    )
    return users.join(new, "userId", "left").select(
        *[F.col(c) for c in users.columns if c not in ("first", "prefGenres")],
        F.coalesce("newFirst", "first").alias("first"),
        F.coalesce("newGenres", "prefGenres").alias("prefGenres"),
    )
