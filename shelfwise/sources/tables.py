"""Stored tables: typed scan, overwrite, bulk load, local rows and the parameter row."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise import schemas
from shelfwise.operators import stats
from shelfwise.sources.keyed import BUCKETS, KeyedTable

USER_BUCKET = "userBucket"
GROUP_BYTES = 8 * 2**20
MOST_KEYS = 1000


class Warehouse:
    """Named tables below a root path.  The format is any data source the cluster has."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", **options: str):
        self.spark, self.root, self.fmt, self.options = spark, root, fmt, options

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        layout = schema or schemas.TABLES[name]
        return self._scan(name, layout).select(*layout.fieldNames())

    def _scan(self, name: str, layout: StructType) -> DataFrame:
        return self.spark.read.schema(layout).format(self.fmt).options(**self.options).load(self.path(name))

    def keyed(self, name: str, schema: StructType | None = None, key: str = "userId", buckets: int = BUCKETS) -> KeyedTable:
        """A table of which rows are replaced by key.  ``buckets`` counts only when the table is made."""
        layout = schema or schemas.TABLES[name]
        return KeyedTable(self.spark, self.path(name), layout, key, buckets, self.fmt, **self.options)

    def ratings_by_user(self, buckets: int = BUCKETS) -> KeyedTable:
        """The rating table, for reading and replacing a few users' folders only."""
        # A bucket with a very active user is spread over several files.
        spread = F.pmod(F.xxhash64("productId"), F.lit(8))
        return KeyedTable(
            self.spark, self.path("Rating"), schemas.RATING, "userId", buckets, self.fmt, USER_BUCKET, spread, **self.options
        )

    def overwrite(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").format(self.fmt).options(**self.options).save(self.path(name))

    def load(self, products: DataFrame, ratings: DataFrame, buckets: int = BUCKETS) -> None:
        """First load: both base tables, replacing what was there; ratings in folders by user bucket."""
        self.overwrite("Product", products)
        by_user = self.ratings_by_user(buckets)
        by_user.overwrite(ratings, buckets)
        self.totals(buckets).overwrite(stats.totals(by_user.read()), buckets)

    def totals(self, buckets: int = BUCKETS) -> KeyedTable:
        """What the statistics are made of, by product; kept up to date by every job that changes ratings."""
        return self.keyed("RatingTotals", key="productId", buckets=buckets)

    def add_totals(self, change: DataFrame, batch: int | None = None) -> None:
        """Merges changed totals into the folders of their products."""
        known = self.totals()
        touched = known.buckets_of(change)
        known.rewrite(touched, stats.merged(known.rows_in(touched).unionByName(change)), batch)

    def add_ratings(self, ratings: DataFrame, batch: int | None = None) -> None:
        """Further ratings beside the stored ones: only the folders of their users and products are read and written."""
        by_user = self.ratings_by_user()
        touched = by_user.buckets_of(ratings)
        new = ratings.select(*schemas.RATING.fieldNames())
        self.add_totals(stats.totals(new), batch)
        by_user.rewrite(touched, by_user.rows_in(touched).unionByName(new), batch)

    def register(self, *names: str) -> None:
        """Make stored tables queryable by name in SQL."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)


def save_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``rows`` written hashed and sorted on ``key`` and read again: joins and groups on the key need no exchange."""
    spark = rows.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    # One task a bucket, so a bucket is one file.
    dealt = rows.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved now: the name is not needed any more, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table


def save_for_look_up(rows: DataFrame, path: str, key: str, group_bytes: int = GROUP_BYTES) -> None:
    """``rows`` sorted by ``key`` in row groups with a Bloom filter each, for ``look_up``."""
    writer = rows.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite")
    writer = writer.option("parquet.block.size", str(group_bytes)).option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


def look_up(table: DataFrame, keys: DataFrame, key: str, most: int = MOST_KEYS) -> DataFrame:
    """Rows of the given keys.  Up to ``most`` keys are handed to the scan, which leaves out row groups by their range
    and Bloom filter; more are joined.  The rows are the same."""
    asked = keys.select(key).distinct()
    few = [r[0] for r in asked.where(F.col(key).isNotNull()).limit(most + 1).collect()]
    if len(few) > most:
        return table.join(asked, key, "left_semi")
    return table.where(F.col(key).isin(few))


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """A few driver-made rows as a table (the outcome of a parameter search)."""
    return spark.createDataFrame(list(rows), schema)


def best_params(params: DataFrame) -> Row | None:
    """The parameter row with the least error."""
    return params.orderBy("rmse", "impFeatureNum", "iterations", "lambda").first()
