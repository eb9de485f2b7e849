"""The driver's tables seen as ratings, products, users, vectors and log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import scalars as fn
from shelfwise.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, productId, score, timestamp: one rating per order line."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("productId"),
        (F.col("l_quantity") / 10).alias("score"),
        F.unix_timestamp("o_orderdate").alias("timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """productId, name, imageUrl, categories, tags."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("productId"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string")).alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.concat_ws("|", F.translate("p_name", " ", "|"), "p_brand", "p_type").alias("tags"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, username, first, timestamp, prefGenres: accounts before any preference is set."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("userId"),
        F.col("c_name").alias("username"),
        F.lit(True).alias("first"),
        F.lit(0).cast("bigint").alias("timestamp"),
        F.array().cast("array<string>").alias("prefGenres"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, vector (array of double)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    )


def _event_product() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1)


def log_lines(events: DataFrame) -> DataFrame:
    """value: the application log as text; purchases are rating lines. Works on a stream too."""
    rating = fn.log_line(
        F.col("user_id"), _event_product(), F.col("event_id") % 5 + 1, F.unix_timestamp("ts")
    )
    return events.select(
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("INFO app "), rating))
        .otherwise(F.concat(F.lit("INFO "), F.col("event_type")))
        .alias("value")
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines(table(spark, sf_dir, "events"))


def rating_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, productId, uiScore (ten-point), timestamp: what the rating form posts."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("user_id").alias("userId"),
            _event_product().cast("bigint").alias("productId"),
            (F.col("event_id") % 10 + 1).cast("double").alias("uiScore"),
            F.unix_timestamp("ts").alias("timestamp"),
        )
    )
