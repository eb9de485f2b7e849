"""Delimited text files of products and ratings, and the log text sink."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas

# Fixed layout of a product line: seven ^-separated fields.
PRODUCT_DELIMITER = r"\^"
PRODUCT_FIELDS = {"productId": 0, "name": 1, "imageUrl": 4, "categories": 5, "tags": 6}


class Loaded(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def parse_products(lines: DataFrame) -> Loaded:
    """Product lines -> rows, plus the lines that have no id or fewer than seven fields."""
    parts = F.split("value", PRODUCT_DELIMITER)
    parsed = lines.select(
        "value",
        *[F.trim(F.get(parts, F.lit(i))).alias(name) for name, i in PRODUCT_FIELDS.items()],
    ).withColumn("productId", F.col("productId").try_cast("bigint"))
    usable = F.col("productId").isNotNull() & F.col("tags").isNotNull()
    return Loaded(parsed.where(usable).drop("value"), parsed.where(~usable).select("value"))


def read_products(spark: SparkSession, path: str) -> Loaded:
    return parse_products(spark.read.text(path))


def parse_rating_lines(lines: DataFrame) -> Loaded:
    """``userId,productId,score,timestamp`` lines -> ratings, plus the lines that lack a field.

    Split and cast by hand: the CSV source would judge a line only by the columns a query reads.
    """
    parts = F.split("value", ",")
    parsed = lines.select(
        "value",
        *[
            F.trim(F.get(parts, F.lit(i))).try_cast(field.dataType).alias(field.name)
            for i, field in enumerate(schemas.RATING.fields)
        ],
    )
    whole = F.lit(True)
    for field in schemas.RATING.fields:
        whole = whole & F.col(field.name).isNotNull()
    return Loaded(parsed.where(whole).drop("value"), parsed.where(~whole).select("value"))


def read_ratings(spark: SparkSession, path: str) -> Loaded:
    return parse_rating_lines(spark.read.text(path))


def product_lines(products: DataFrame) -> DataFrame:
    """The inverse of ``parse_products``; the two dropped fields stay empty."""
    empty = F.lit("")
    return products.select(
        F.concat_ws(
            "^", F.col("productId").cast("string"), "name", empty, empty, "imageUrl", "categories", "tags"
        ).alias("value")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Append text lines (column ``value``) to a folder a shipper tails."""
    lines.select("value").write.mode("append").text(path)
