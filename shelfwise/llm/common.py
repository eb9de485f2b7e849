"""What several operators share: reading, intermediate tables, word counts and the learn/hold-out rule."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import drop_run, run_dir, shuffles_dropped, use_utc

#: What separates words (blank, tab, line feed, vertical tab, form feed, carriage return).
WORD = r"[^\x20\x09-\x0D]+"
HOLD_OUT_PARTS = 3


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, lost executors cost nothing, and shuffles of the write go with it."""
    spark = df.sparkSession
    path = run_dir(spark, purpose)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``stored`` that nothing reads any more, results that are still to be computed included."""
    for table in tables:
        for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
            drop_run(table.sparkSession, path)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def is_held_out(id_col: Column) -> Column:
    """True for the third of the ids that no model may learn labels from. A null id is learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % HOLD_OUT_PARTS == 1, F.lit(False))


def parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, so that a worker holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
