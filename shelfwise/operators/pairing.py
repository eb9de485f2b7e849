"""Equi-joins whose large keys are cut into chunk pairs.

A key with n members needs n*n/2 comparisons.  When one key holds a large share
of the rows, they must not land in one task: members are spread over
``chunks`` chunks and every unordered chunk pair is a join key of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def chunk_count(size: Column, limit: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / F.lit(limit))).cast("int")


def chunk_of(member: Column, chunks: Column) -> Column:
    return F.pmod(F.xxhash64(member), chunks).cast("int")


def chunk_pair_sides(rows: DataFrame, chunk: str, chunks: str) -> tuple[DataFrame, DataFrame]:
    """Left and right inputs of the self-join, each with ``lo`` and ``hi`` to be joined on.

    Left members sit in chunk ``lo``, right members in chunk ``hi``; lo <= hi.  A
    key of one chunk is not replicated.
    """
    left = rows.withColumn("lo", F.col(chunk)).withColumn(
        "hi", F.explode(F.sequence(F.col(chunk), F.col(chunks) - 1))
    )
    right = rows.withColumn("hi", F.col(chunk)).withColumn(
        "lo", F.explode(F.sequence(F.lit(0), F.col(chunk)))
    )
    return left.drop(chunk, chunks), right.drop(chunk, chunks)


def parts(spark: SparkSession) -> int:
    """Partitions for a join that multiplies rows: as set, and no fewer than there are cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitions the input of a join that multiplies rows.

    Partition sizes before such a join say little about the work after it, so they must not be merged
    by size; a given partition number is kept as it is.
    """
    return rows.repartition(parts(rows.sparkSession), *keys)


def once(left_member: str, right_member: str) -> Column:
    """True for exactly one orientation of an unordered pair (used with lo, hi)."""
    return (F.col("lo") < F.col("hi")) | (F.col(left_member) < F.col(right_member))
