from shelfwise import schemas
from shelfwise.operators import loglines, stats, upserts
from shelfwise.plans import jobs, serving
from shelfwise.session import run_dir
from shelfwise.sources import files, tables
from shelfwise.sources.keyed import KeyedTable
from shelfwise.sources.tables import Warehouse


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_product_lines(spark):
    loaded = files.parse_products(
        lines(spark, "1^ n ^c^a^u^k|l^t|s", "2^n^c^a^u^k^", "3^n^c", "x^n^c^a^u^k^t")
    )
    assert sorted(map(tuple, loaded.rows.collect())) == [(1, "n", "u", "k|l", "t|s"), (2, "n", "u", "k", "")]
    assert sorted(r.value for r in loaded.rejects.collect()) == ["3^n^c", "x^n^c^a^u^k^t"]


def test_rating_files(spark):
    path = run_dir(spark, "ratings")
    files.write_lines(lines(spark, "4867,457976,5.0,1395676800", "4867,bad,5.0,1"), path)
    loaded = files.read_ratings(spark, path)
    assert [tuple(r) for r in loaded.rows.collect()] == [(4867, 457976, 5.0, 1395676800)]
    assert [r.value for r in loaded.rejects.collect()] == ["4867,bad,5.0,1"]


def test_log_lines(spark):
    log = lines(
        spark,
        "INFO x: PRODUCT_RATING_PREFIX:4867|8195|4.0|1576740780",
        "INFO PRODUCT_RATING_PREFIX: 4867|3982|2.0|1576740790",
        "noise line",
        "PRODUCT_RATING_PREFIX:bad|row",
        "PRODUCT_RATING_PREFIX:1|2|3.0|4 PRODUCT_RATING_PREFIX:5|6|1.0|8",
    )
    parsed = loglines.parse_ratings(loglines.rating_lines(log))
    assert sorted(map(tuple, parsed.ratings.collect())) == [
        (1, 2, 3.0, 4),
        (4867, 3982, 2.0, 1576740790),
        (4867, 8195, 4.0, 1576740780),
    ]
    assert [r.value for r in parsed.rejects.collect()] == ["bad|row"]


def test_upsert_keeps_first_time(spark):
    schema = "userId long, productId long, score double, timestamp long"
    base = spark.createDataFrame([(1, 7, 4.0, 10), (1, 8, 2.0, 10)], schema)
    updates = spark.createDataFrame([(1, 7, 5.0, 20), (2, 9, 1.0, 30), (2, 9, 3.0, 40)], schema)
    got = sorted(map(tuple, upserts.upsert_ratings(base, updates).collect()))
    assert got == [(1, 7, 5.0, 10), (1, 8, 2.0, 10), (2, 9, 3.0, 30)]


def test_requests_become_ratings_and_log_lines(spark):
    requests = spark.createDataFrame(
        [(1, 7, 9.0, 1576740780000)], "userId long, productId long, uiScore double, timestamp long"
    )
    ratings = upserts.from_requests(requests)
    assert [tuple(r) for r in ratings.collect()] == [(1, 7, 4.5, 1576740780)]
    assert upserts.rating_log(ratings).first().value == "PRODUCT_RATING_PREFIX:1|7|4.5|1576740780"


def test_preferences(spark):
    users = spark.createDataFrame(
        [(1, "a", True, 0, ["x"]), (2, "b", True, 0, [])],
        "userId long, username string, first boolean, timestamp long, prefGenres array<string>",
    )
    changes = spark.createDataFrame([(2, False, ["y"])], "userId long, first boolean, prefGenres array<string>")
    got = {r.userId: (r.first, r.prefGenres) for r in upserts.update_preferences(users, changes).collect()}
    assert got == {1: (True, ["x"]), 2: (False, ["y"])}


def test_jobs_hand_over_through_tables(spark):
    root = run_dir(spark, "warehouse")
    products = [f"{i}^name {i}^c^a^img^cat^{'a|b' if i % 2 else 'a|c|d' + str(i)}" for i in range(12)]
    ratings = [f"{u},{p},{(u * p) % 5 + 1}.0,{1_500_000_000 + u * p}" for u in range(20) for p in range(12) if (u + p) % 3]
    files.write_lines(lines(spark, *products), f"{root}/products")
    files.write_lines(lines(spark, *ratings), f"{root}/ratings")
    store = Warehouse(spark, f"{root}/tables")
    jobs.load(store, f"{root}/products", f"{root}/ratings")
    jobs.statistics(store)
    jobs.item_lists(store)
    jobs.content(store, 20)
    jobs.search(store, ranks=(2,), iterations=(3,), lambdas=(0.1, 1.0))
    jobs.offline(store)
    assert store.read("ContentRankedGroups").count() == store.read("ContentGroupPairs").count() > 0
    posts = spark.createDataFrame([(0, 1, 9.0, 1_600_000_000), (99, 1, 4.0, 1_600_000_000)], "userId long, productId long, uiScore double, timestamp long")
    rating_files = lambda: {f.split("userBucket=")[1] for f in store.ratings_by_user().scan().inputFiles()}
    before = rating_files()
    touched = jobs.rate(store, posts, 1)
    changed = {int(f.split("/")[0]) for f in before ^ rating_files()}
    assert changed == set(touched) and len(touched) == 2
    assert {r.userId for r in store.keyed("RatingQueues").read().collect()} == {0, 99}
    assert store.read("RatingLog", schemas.MESSAGE).count() == 2
    whole = store.read("Rating").collect()
    assert jobs.rate(store, posts, 1) == touched  # the same batch again
    assert sorted(store.read("Rating").collect()) == sorted(whole)
    assert store.read("Rating").count() == len(ratings) + 1 + (1 if store.read("Rating").where("userId = 0 AND productId = 1").first().timestamp == 1_600_000_000 else 0)
    assert store.read("Rating").where("userId = 0 AND productId = 1").first().score == 4.5
    params = tables.best_params(store.read("OptedParams"))
    assert params["impFeatureNum"] == 2 and params["rmse"] > 0
    assert store.read("UserRecs").count() == 20
    store.register("AverageProducts", "ItemCFProductRecs", "ContentBasedProductRecs", "ProductRecs")
    assert spark.sql("SELECT count(*) AS n FROM AverageProducts").first().n == 12
    assert spark.sql("SELECT max(size(recs)) AS n FROM ItemCFProductRecs").first().n == 11
    odd = spark.sql("SELECT recs FROM ContentBasedProductRecs WHERE productId = 1").first().recs
    assert [r.productId for r in odd][:5] == [3, 5, 7, 9, 11]
    hot = serving.hot_products(
        store.read("RateMoreRecentlyProducts"), store.read("Product"), store.read("AverageProducts"), 5
    )
    assert hot.count() == 5
    assert serving.by_key(store.read("Product"), "productId", 3).first().name == "name 3"
    assert serving.by_key(store.read("Product"), "productId", 99).count() == 0


def test_bucketed_table_joins_without_exchange(spark):
    rows = spark.range(1000).selectExpr("id % 50 as productId", "id as userId")
    ratings = tables.save_bucketed(rows, run_dir(spark, "bucketed"), "productId", 4)
    products = tables.save_bucketed(spark.range(50).selectExpr("id as productId", "id as x"), run_dir(spark, "bucketed"), "productId", 4)
    joined = ratings.hint("merge").join(products, "productId")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert joined.count() == 1000


def test_posts_move_their_own_rows_and_a_stage_is_not_dealt_out_again(spark, monkeypatch):
    store = tables.Warehouse(spark, run_dir(spark, "small-posts"))
    rows = [(u, p, 4.0, 86400 * 40 * p) for u in range(20) for p in range(6)] + [(3, 1, 2.0, 5)]
    ratings = spark.createDataFrame(rows, schemas.RATING)
    store.load(spark.createDataFrame([], schemas.PRODUCT), ratings, 2)
    posts = spark.createDataFrame([(3, 1, 10.0, 900), (3, 77, 2.0, 901), (21, 2, 6.0, 902)], "userId long, productId long, uiScore double, timestamp long")
    plans, write = [], KeyedTable._write

    def noted(self, given, path, overwrite):
        if overwrite == "dynamic":
            plans.append(given._jdf.queryExecution().executedPlan().toString())
        write(self, given, path, overwrite)

    monkeypatch.setattr(KeyedTable, "_write", noted)
    jobs.rate(store, posts)
    assert len(plans) == 3 and not any("Exchange" in plan for plan in plans)
    assert store.read("RatingNext", schemas.RATING).count() == 3
    after = store.read("Rating")
    wanted = [(u, p, 4.0, t) for u, p, _, t in rows if (u, p) != (3, 1)] + [(3, 1, 5.0, 86400 * 40), (3, 77, 1.0, 901), (21, 2, 3.0, 902)]
    assert sorted(map(tuple, after.collect())) == sorted(wanted)
    totals = {(r.productId, r.month): (r.n, float(r.total)) for r in store.read("RatingTotals").collect()}
    assert totals == {(r.productId, r.month): (r.n, float(r.total)) for r in stats.totals(after).collect()}
