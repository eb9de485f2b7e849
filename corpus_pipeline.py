"""The training-data pipeline as named stages; each stage's rows are written and read by the next.

Every stage but the last returns the columns of ``documents``: texts of no known language go and ``lang`` becomes
the predicted one; one document of each near-duplicate group stays; personal data is replaced in the texts;
documents come as often as the mix of sources takes them; the last stage gives the token ids of what is left.

Edge cases are those of the operators (see their modules): null and empty texts go at the first stage, since they have
no letter; null ids, null sources, repeated rows and empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, langid, minhash, mixing, pii
from shelfwise.llm.common import documents, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE_WORDS = 5
PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, named by prediction."""
    return langid.keep_known(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.without_copies(docs.select(*COLUMNS), width=SHINGLE_WORDS, percent=PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    clean = pii.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, to the nearest whole number; of one without words nothing is taken."""
    keyed = docs.select(F.xxhash64(*COLUMNS).alias("row"), *COLUMNS)
    line, pieces = mixing.mix(keyed, id_col="row")
    share = mixing.taken(line, pieces).groupBy("doc_id").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("share"))
    times = share.select(F.col("doc_id").alias("row"), F.floor(F.col("share") + 0.5).cast("int").alias("times"))
    chosen = stored(times.where("times > 0"), "mix-times")
    # One row a document, so merged with the texts at every size, never broadcast.
    return keyed.join(chosen.hint("merge"), "row").withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every document that is left."""
    return bpe.encode(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [("language", language), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mix", mix), ("byte_bpe", tokens)]

#: The learned stages cannot be expressed in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
