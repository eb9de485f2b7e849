import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import name_search, recs, stats
from shelfwise.plans import jobs
from shelfwise.session import run_dir
from shelfwise.sources import tables
from shelfwise.sources.tables import Warehouse

NAMES = ["blue ring", "spring", "bluering", "blu", "", None, "a.b.c", "light light steel", "light steel", "steel", "é日本語é", "ring blue", "x" * 500, "aabab"]


def names(spark, n=200):
    r = random.Random(4)
    words = ["blue", "ring", "green", "rose", "royal", "steel", "light", "an", "é日本"]
    more = [" ".join(r.choices(words, k=r.randrange(1, 5))) for _ in range(n)]
    return spark.createDataFrame([(i, t) for i, t in enumerate([*NAMES, *more])], "productId long, name string")


@pytest.mark.parametrize(
    "pattern, by_index",
    [
        ("blue|ring", True), ("^light.*steel$", True), ("(light )+steel", True), ("(blue|green) ro(se|yal)", True), ("日本語", True),
        ("blue.?", True), ("(?:rose)?blue", True), ("(rose)?", False), ("a.b", False), ("a\\.b\\.c", True), ("[bg]lue ring", True), ("(?i)BLUE", False),
        ("\\Qa.b\\E", False), ("x{3,}", False), ("", False), ("blu|r", False), ("[a[b]]lue", False), ("(ab)+ab", False), ("gre+n", False), ("gre+en", False),
    ],
)
def test_index_equals_scan(spark, pattern, by_index):
    rows = names(spark)
    found = name_search.search(rows, name_search.postings(rows, "productId", "name"), pattern, "productId", "name")
    wanted = {r.productId for r in rows.where(F.regexp_like("name", F.lit(pattern))).collect()}
    assert {r.productId for r in found.collect()} == wanted
    assert (name_search.needed(pattern) is not None) == by_index


def test_random_patterns_never_lose_a_match():
    r = random.Random(9)
    atoms = ["blue", "ring", "an", "b", ".", "[a-e]", "(light|steel)", "(?:ro(se|yal))", "x*", "e+", "(an)?", "g{1,2}", "^", "$", "\\d", "(a|b|)"]
    texts = [t for t in NAMES if t] + [" ".join(r.choices(["blue", "ring", "anb", "lightan", "rose", "ggb", "steel7"], k=3)) for _ in range(80)]
    for _ in range(1500):
        pattern = "".join(r.choices(atoms, k=r.randrange(1, 5)))
        if r.random() < 0.3:
            pattern += "|" + "".join(r.choices(atoms, k=2))
        needs = name_search.needed(pattern)
        for text in texts:
            if needs is not None and re.search(pattern, text):
                assert any(need <= name_search.trigrams(text) for need in needs), (pattern, text)


def test_postings_are_read_by_trigram(spark):
    path = run_dir(spark, "trigrams")
    name_search.save(name_search.postings(names(spark, 3000), "productId", "name"), path)
    posted = spark.read.schema("trigram string, id bigint").parquet(path)
    plan = name_search.candidates(posted, name_search.needed("blue"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram" in plan


def scanned(df):
    """Rows that the scan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.getClass().getName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_look_up_reads_few_row_groups(spark):
    path = run_dir(spark, "lists")
    rows = spark.range(200_000).select((F.col("id") * 2).alias("userId"), F.sha2(F.col("id").cast("string"), 256).alias("recs"))
    tables.save_for_look_up(rows.repartition(8), path, "userId", 2**20)
    table = spark.read.schema("userId bigint, recs string").parquet(path)
    keys = spark.createDataFrame([(i,) for i in [*range(40, 46), 300_000, 300_001, None, 10**9]], "userId long")
    found = tables.look_up(table, keys, "userId")
    assert sorted(r.userId for r in found.collect()) == [40, 42, 44, 300_000]
    assert 0 < scanned(tables.look_up(table, keys, "userId")) < 50_000
    # Between two stored keys: only the Bloom filters can tell.
    odd = spark.createDataFrame([(2 * i + 1,) for i in range(1000, 1010)], "userId long")
    assert scanned(tables.look_up(table, odd, "userId")) < 50_000
    many = spark.range(3000).withColumnRenamed("id", "userId")
    assert tables.look_up(table, many, "userId").count() == 1500


def test_whole_ranks_spread_one_key(spark):
    r = random.Random(3)
    rows = [(7, i, r.randrange(40) / 40) for i in range(4000)] + [(k, i, 0.5) for k in range(20) for i in range(3)]
    df = spark.createDataFrame(rows, "grp long, simGrp long, score double")
    path = run_dir(spark, "ranks")
    got = recs.whole_ranks(df, "grp", [F.desc("score"), F.col("simGrp")], path)
    wanted = {}
    for key in {k for k, _, _ in rows}:
        for place, (_, _, i, s) in enumerate(sorted((k, -s, i, s) for k, i, s in rows if k == key)):
            wanted[key, i, s] = wanted.get((key, i, s), []) + [place + 1]
    found = {}
    for x in got.collect():
        found.setdefault((x.grp, x.simGrp, x.score), []).append(x["rank"])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}
    parts = spark.read.parquet(path).where("grp = 7").select("part").distinct().count()
    assert parts >= 6


def test_statistics_kept_equal_a_full_recompute(spark):
    r = random.Random(5)
    rows = [(r.randrange(30), r.randrange(12), r.randrange(1, 11) / 2, 1_500_000_000 + r.randrange(10**7)) for _ in range(600)]
    layout = "userId long, productId long, score double, timestamp long"
    store = Warehouse(spark, run_dir(spark, "kept"))
    products = spark.createDataFrame([(1, "n", "i", "c", "t")], "productId long, name string, imageUrl string, categories string, tags string")
    store.load(products, spark.createDataFrame(rows[:300], layout), 8)
    for n in range(5):
        store.add_ratings(spark.createDataFrame(rows[300 + 60 * n : 360 + 60 * n], layout), n)
        store.add_ratings(spark.createDataFrame(rows[300 + 60 * n : 360 + 60 * n], layout), n)  # run again
    posts = spark.createDataFrame([(u, u % 14, 9.0, 1_600_000_000) for u in range(25)], "userId long, productId long, uiScore double, timestamp long")
    jobs.rate(store, posts, 7)
    jobs.rate(store, posts, 7)
    known, ratings = store.read("RatingTotals"), store.read("Rating")
    assert sorted(known.collect()) == sorted(stats.totals(ratings).collect())
    assert stats.most_rated_of(known).collect() == stats.most_rated(ratings).collect()
    assert stats.most_rated_by_month_of(known).collect() == stats.most_rated_by_period(ratings).collect()
    mean = lambda df: [(x.productId, round(x.avg, 9)) for x in df.collect()]
    assert mean(stats.average_scores_of(known)) == mean(stats.average_scores(ratings))
