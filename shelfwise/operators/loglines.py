"""Rating lines of the application log.  Stateless, so the same for batches and streams."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scalars as fn


class Parsed(NamedTuple):
    ratings: DataFrame
    rejects: DataFrame


def rating_lines(lines: DataFrame) -> DataFrame:
    """Keeps lines with the rating prefix, reduced to what follows it."""
    after = F.get(F.split("value", fn.RATING_PREFIX), F.lit(1))
    return lines.where(F.col("value").contains(fn.RATING_PREFIX)).select(F.trim(after).alias("value"))


def _fields(messages: DataFrame) -> DataFrame:
    parts = F.split("value", r"\|")
    return messages.select(
        "value",
        F.get(parts, F.lit(0)).try_cast("bigint").alias("userId"),
        F.get(parts, F.lit(1)).try_cast("bigint").alias("productId"),
        F.get(parts, F.lit(2)).try_cast("double").alias("score"),
        fn.epoch_seconds(F.get(parts, F.lit(3)).try_cast("bigint")).alias("timestamp"),
    )


def parse_ratings(messages: DataFrame) -> Parsed:
    """``userId|productId|score|timestamp`` messages -> ratings and rejected messages."""
    rows = _fields(messages)
    whole = (
        F.col("userId").isNotNull()
        & F.col("productId").isNotNull()
        & F.col("score").isNotNull()
        & F.col("timestamp").isNotNull()
    )
    return Parsed(rows.where(whole).drop("value"), rows.where(~whole).select("value"))
