import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import scalars as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def java_hash(name):
    units = name.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - 2**32 if h >= 2**31 else h


@pytest.mark.parametrize("name", ["shopper", "Customer#000000001", "", "名字", "smile \U0001f600"])
def test_user_id(spark, name):
    assert value(spark, fn.user_id(F.lit(name))) == java_hash(name)


def test_month_bucket(spark):
    assert value(spark, fn.time_bucket(F.lit(1260759144))) == 200912
    assert value(spark, fn.time_bucket(F.lit(1260759144), "yyyymm")) == 200952


def test_half_score(spark):
    assert value(spark, fn.half_score(F.lit(7.125))) == 3.56


def test_epoch_seconds(spark):
    assert value(spark, fn.epoch_seconds(F.lit(1576740780123))) == 1576740780
    assert value(spark, fn.epoch_seconds(F.lit(1576740780))) == 1576740780


def test_cosine(spark):
    def a(*xs):
        return F.array(*[F.lit(float(x)) for x in xs])

    assert value(spark, fn.cosine(a(1, 0), a(1, 1))) == pytest.approx(1 / math.sqrt(2))
    assert value(spark, fn.cosine(a(0, 0), a(1, 0))) is None


def test_cooccurrence_score_does_not_overflow(spark):
    big = 5_000_000_000
    assert value(spark, fn.cooccurrence_score(F.lit(1), F.lit(big), F.lit(big))) == pytest.approx(1 / big)


def test_queue_entry_round_trip(spark):
    entry = fn.queue_entry(F.lit(42), F.lit(4.5))
    assert value(spark, entry) == "42:4.5"
    assert value(spark, fn.queue_product(entry)) == 42
    assert value(spark, fn.queue_score(entry)) == 4.5


def test_repair_charset(spark):
    broken = "鼠标".encode().decode("latin-1")
    assert value(spark, fn.repair_charset(F.lit(broken))) == "鼠标"


def test_tokens_follow_whitespace(spark):
    assert value(spark, fn.tokens(fn.tags_to_text(F.lit("Red|Big Ring|")))) == ["red", "big", "ring"]


def test_log10_count(spark):
    assert value(spark, fn.log10_count(F.lit(0))) == 0.0
    assert value(spark, fn.log10_count(F.lit(100))) == pytest.approx(2.0)
