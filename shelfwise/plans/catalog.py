"""Every query by name: (session, folder of the driver tables) -> DataFrame.

Each one reads whole tables.  Doubles are rounded to six decimals on output.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions import scalars as fn
from shelfwise.operators import als, dense, itemcf, loglines, name_search, online, similarity, stats, text, upserts
from shelfwise.operators import recs as rc
from shelfwise.plans import jobs, serving
from shelfwise.session import run_dir, shuffles_dropped
from shelfwise.sources import bindings as src
from shelfwise.sources import files, streams, tables, topics
from shelfwise.sources.keyed import KeyedTable
from shelfwise.streaming import pipelines

DIGITS = 6
TOP = 20
NEIGHBOURS = 10


def six(name: str) -> Column:
    return F.round(name, DIGITS).alias(name)


# --- statistics -------------------------------------------------------------------------


def rate_more_products(spark: SparkSession, sf: str) -> DataFrame:
    return stats.most_rated(src.ratings(spark, sf))


def rate_more_recently(spark: SparkSession, sf: str) -> DataFrame:
    return stats.most_rated_by_period(src.ratings(spark, sf))


def average_products(spark: SparkSession, sf: str) -> DataFrame:
    return stats.average_scores(src.ratings(spark, sf)).select("productId", six("avg"))


def statistics_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics from totals that two loads and the form posts kept up to date, without reading the ratings again."""
    store = tables.Warehouse(spark, run_dir(spark, "kept"))
    # Stored, because loading and adding read them several times.
    ratings, path = src.ratings(spark, sf), run_dir(spark, "ratings")
    ratings.write.parquet(path)
    ratings = spark.read.schema(ratings.schema).parquet(path)
    late = F.pmod(F.xxhash64("userId", "timestamp"), F.lit(3)) == 0
    store.load(src.products(spark, sf), ratings.where(~late), 8)
    store.add_ratings(ratings.where(late), 1)
    jobs.rate(store, src.rating_requests(spark, sf), 2)
    known = store.read("RatingTotals")
    counts, means = stats.most_rated_of(known), stats.average_scores_of(known)
    months = known.groupBy("productId").agg(F.count(F.lit(1)).alias("months"), F.max("month").alias("newest"))
    return counts.join(means, "productId").join(months, "productId").select("productId", "count", six("avg"), "months", "newest")


def top5_average(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_n(stats.average_scores(src.ratings(spark, sf)), 5).select("productId", six("avg"))


def distinct_users_products(spark: SparkSession, sf: str) -> DataFrame:
    users, products = stats.distinct_ids(src.ratings(spark, sf))
    return users.select(F.lit("user").alias("kind"), F.col("userId").alias("id")).unionByName(
        products.select(F.lit("product").alias("kind"), F.col("productId").alias("id"))
    )


# --- item similarity --------------------------------------------------------------------


def itemcf_top20(spark: SparkSession, sf: str) -> DataFrame:
    top = itemcf.top_similar(src.ratings(spark, sf), TOP)
    return top.select("product1", "product2", "cocount", "count1", "count2", six("score"), "rank")


def itemcf_recs_list(spark: SparkSession, sf: str) -> DataFrame:
    lists = itemcf.rec_table(itemcf.top_similar(src.ratings(spark, sf), TOP))
    return lists.select("productId", F.size("recs").alias("n"), rc.render("recs").alias("recs"))


def sim_map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity of every logged product to the user's five newest ratings, 0.0 where unlisted."""
    ratings = src.ratings(spark, sf)
    maps = rc.as_map(itemcf.rec_table(itemcf.top_similar(ratings, TOP)), "productId")
    latest = online.latest_per_user(_log_ratings(spark, sf)).select("userId", "productId")
    recent = online.recent_ratings(ratings, 5).select(
        "userId", F.col("rank"), F.col("productId").alias("recentId")
    )
    asked = latest.join(recent, "userId").join(maps, "productId", "left")
    return asked.select(
        "userId", "productId", "recentId", "rank", F.round(rc.map_score("sims", "recentId"), DIGITS).alias("sim")
    )


def _group_pairs(sim: similarity.Similarity) -> DataFrame:
    return sim.pairs.select(F.col("grp").alias("id"), F.col("simGrp").alias("simId"), six("score"))


def vector_cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _group_pairs(dense.cosine_similarity(src.vectors(spark, sf), 0.3))


def vector_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Members of the groups of equal vectors that ``vector_cosine_pairs`` names."""
    members = dense.distinct_vectors(src.vectors(spark, sf))[0]
    return members.select(F.col("productId").alias("id"), "grp")


def factor_scores_top20(spark: SparkSession, sf: str) -> DataFrame:
    factors = src.vectors(spark, sf)
    return dense.top_products(factors, factors, TOP).select("userId", "productId", six("score"), "rank")


def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    return text.tfidf(src.products(spark, sf)).select("productId", "term", "tf", six("weight"))


def content_similar(spark: SparkSession, sf: str) -> DataFrame:
    """All similar pairs of groups of equally tagged products; ``content_groups`` has the members."""
    return _group_pairs(similarity.content_similarity(src.products(spark, sf)))


def content_groups(spark: SparkSession, sf: str) -> DataFrame:
    return text.group_members(src.products(spark, sf))


def content_ranked_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Whole ranked lists, group by group."""
    ranked = similarity.ranked_groups(similarity.content_similarity(src.products(spark, sf)))
    return ranked.select("grp", "rank", "simGrp", six("score"))


def content_top20(spark: SparkSession, sf: str) -> DataFrame:
    products = src.products(spark, sf)
    top = similarity.top_similar(similarity.content_similarity(products), products, TOP)
    return top.select("productId", "simProductId", six("score"), "rank")


def content_similar_hashed(spark: SparkSession, sf: str) -> DataFrame:
    return _group_pairs(similarity.hashed_content_similarity(src.products(spark, sf)))


def content_similar_md5(spark: SparkSession, sf: str) -> DataFrame:
    """The hashed similarity with buckets that SQL can compute too."""
    return _group_pairs(similarity.bucket_content_similarity(src.products(spark, sf), text.md5_bucket))


# --- matrix factorisation ---------------------------------------------------------------


def _hash_split(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A repeatable 75/25 split of the ratings."""
    test = (F.col("userId") * 31 + F.col("productId") * 17) % 4 == 0
    return ratings.where(~test), ratings.where(test)


def _mean_predictions(train: DataFrame, pairs: DataFrame) -> DataFrame:
    means = train.groupBy("productId").agg(F.avg("score").alias("prediction"))
    return pairs.select("userId", "productId").join(means, "productId")


def rmse_eval(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _hash_split(src.ratings(spark, sf))
    return als.rmse(test, _mean_predictions(train, test)).select(six("rmse"))


def grid_argmin(spark: SparkSession, sf: str) -> DataFrame:
    """Best damping of the product mean among the regularisation grid: error per value, then the least."""
    train, test = _hash_split(src.ratings(spark, sf))
    overall = train.agg(F.avg("score")).scalar()
    sums = train.groupBy("productId").agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("n"))
    reg = F.col("lambda")
    damped = sums.withColumn("lambda", F.explode(F.array(*[F.lit(x) for x in als.LAMBDAS]))).select(
        "productId", "lambda", ((F.col("s") + reg * overall) / (F.col("n") + reg)).alias("prediction")
    )
    predicted = test.select("userId", "productId").join(damped, "productId")
    errors = als.rmse(test, predicted, ["lambda"]).select(
        F.lit(0).alias("impFeatureNum"), F.lit(1).alias("iterations"), "lambda", "rmse"
    )
    return als.best(errors).select("impFeatureNum", "iterations", "lambda", six("rmse"))


def als_recommend(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's best products by the fitted factors; ``als_checks`` holds them against the factors."""
    return als.user_top(_model(spark, sf), TOP)


def als_item_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """Each product's most similar by the fitted factors; ``als_checks`` holds them against the factors."""
    sim = als.top_items(_model(spark, sf), TOP)
    return similarity.top_similar(sim, sim.members, TOP)


def _model(spark: SparkSession, sf: str):
    return als.fit(src.ratings(spark, sf), 5, 10, 0.1)


def _list_checks(rows: DataFrame, key: str, item: str, a: DataFrame, b: DataFrame, size: int, scale: bool, least: float) -> DataFrame:
    """One row: number of lists, and whether lengths, order and scores are what the factors (of ``size`` numbers) give."""
    # Number by number, which is compiled; functions over arrays are not.
    dot = lambda x, y: reduce(Column.__add__, [F.get(x, F.lit(i)) * F.get(y, F.lit(i)) for i in range(size)], F.lit(0.0))
    # By the key last, as the window wants it.
    paired = rows.join(b.select(F.col("id").alias(item), F.col("vector").alias("w")), item).join(
        a.select(F.col("id").alias(key), F.col("vector").alias("v")), key
    )
    value = dot("v", "w")
    if scale:
        value = value / F.sqrt(dot("v", "v") * dot("w", "w"))
    before = F.lag("score").over(Window.partitionBy(key).orderBy("rank"))
    each = paired.select(
        key, "rank", "score", (F.abs(F.col("score") - value) < 1e-6).alias("right"), (before < F.col("score") - 1e-6).alias("rises")
    )
    return each.agg(
        F.count_distinct(key).alias("lists"),
        (F.max("rank") <= TOP).alias("short"),
        F.every("right").alias("right"),
        (~F.coalesce(F.some("rises"), F.lit(False))).alias("ordered"),
        (F.min("score") > least).alias("above"),
    )


#: Users whose lists are held against every product, by a hash of the id.
CHECKED_USERS = 50


def _best_checks(lists: DataFrame, users: DataFrame, items: DataFrame) -> int:
    """How many products beat the last place of a checked user's list, or would fill a short one, and are not in it."""
    asked = users.orderBy(F.xxhash64("id"), "id").limit(CHECKED_USERS).collect()
    # A stated set of users, of whose lists at most as many times ``TOP`` rows come here.
    own = lists.where(F.col("userId").isin([r.id for r in asked])).select("userId", "productId", "score").collect()
    places = Counter(r.userId for r in own)
    last = {u: min(r.score for r in own if r.userId == u) for u, n in places.items() if n == TOP}
    better = dense.products_above(items, [(r.id, r.vector, last.get(r.id, 0.0) + 1e-6) for r in asked])
    listed = users.sparkSession.createDataFrame([(r.userId, r.productId) for r in own], "userId bigint, productId bigint")
    return better.join(listed, ["userId", "productId"], "left_anti").count()


def als_best_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the lists hold the best twenty, and whether the fit predicts what it was fitted to better than the mean does."""
    # Stored, because fit, predictions and errors read them several times; of each step only its own shuffles lie on disk.
    ratings, path = src.ratings(spark, sf).select("userId", "productId", "score"), run_dir(spark, "checked")
    with shuffles_dropped(spark):
        ratings.write.parquet(path)
    train, test = _hash_split(spark.read.schema(ratings.schema).parquet(path))
    model = als.fit(train, 5, 10, 0.1)
    with shuffles_dropped(spark):
        missed = _best_checks(als.user_top(model, TOP), als.user_vectors(model), als.item_vectors(model))
        seen = train.select("userId", "productId").distinct()
        fitted = als.rmse(train, als.predict(model, seen)).first().rmse
        mean = als.rmse(train, seen.withColumn("prediction", F.lit(train.agg(F.avg("score")).first()[0]))).first().rmse
    unseen = als.predict(model, test.select("userId", "productId").distinct())
    return unseen.agg((F.count(F.lit(1)) > 0).alias("predicts")).select(
        F.lit(missed).cast("bigint").alias("missed"), F.lit(fitted < mean).alias("better_than_mean"), "predicts"
    )


def als_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the lists of any fit: per kind of list, how many and whether they follow from the factors."""
    model = _model(spark, sf)
    items, users = als.item_vectors(model), als.user_vectors(model)
    sim = als.top_items(model, TOP)
    similar = similarity.top_similar(sim, sim.members, TOP)
    by_user = _list_checks(als.user_top(model, TOP), "userId", "productId", users, items, model.rank, False, 0.0)
    by_item = _list_checks(similar, "productId", "simProductId", items, items, model.rank, True, als.MIN_SIMILARITY)
    return by_user.select(F.lit("user").alias("kind"), "*").unionByName(by_item.select(F.lit("product").alias("kind"), "*"))


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return als.grid_search(*als.split(src.ratings(spark, sf)))


def als_grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """The winner of the whole parameter grid, which is handed over."""
    return als.best(_grid(spark, sf))


def als_grid_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of any search: one error per combination, all numbers, and the winner's the least."""
    errors = _grid(spark, sf)
    won = als.best(errors).first().rmse
    return errors.agg(
        F.count_distinct("impFeatureNum", "iterations", "lambda").alias("fits"),
        (F.min("rmse") == won).alias("least"),
        F.every((F.col("rmse") > 0) & ~F.isnan("rmse")).alias("numbers"),
    )


# --- log and online ---------------------------------------------------------------------


def _log_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return loglines.parse_ratings(loglines.rating_lines(src.log(spark, sf))).ratings


def rating_log_filter(spark: SparkSession, sf: str) -> DataFrame:
    return loglines.rating_lines(src.log(spark, sf))


def rating_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _log_ratings(spark, sf)


def _messages_with_faults(spark: SparkSession, sf: str) -> DataFrame:
    """The rating messages, a seventh of them damaged: a field lost, or one that is not a number."""
    messages = loglines.rating_lines(src.log(spark, sf))
    kind = F.conv(F.substring(F.md5(F.col("value").cast("binary")), 1, 4), 16, 10).cast("int") % 21
    damaged = (
        F.when(kind == 0, F.substring_index("value", "|", 3))
        .when(kind == 1, F.concat(F.lit("x"), "value"))
        .when(kind == 2, F.concat(F.substring_index("value", "|", 2), F.lit("|?|"), F.substring_index("value", "|", -1)))
        .otherwise(F.col("value"))
    )
    return messages.select(damaged.alias("value"))


def rating_log_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that do not parse are set aside, none fails the job."""
    return loglines.parse_ratings(_messages_with_faults(spark, sf)).rejects


def rating_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The log lines that form posts leave behind."""
    return serving.rate_products(src.rating_requests(spark, sf), src.ratings(spark, sf)).log


def _all_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return src.ratings(spark, sf).unionByName(_log_ratings(spark, sf))


def recent_ratings_per_user(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty newest ratings as queue entries, and what reading an entry gives back."""
    recent = online.recent_ratings(_all_ratings(spark, sf))
    entries = recent.select("userId", "rank", fn.queue_entry("productId", "score").alias("entry"))
    return entries.select(
        "userId", "rank", "entry",
        fn.queue_product("entry").alias("productId"), fn.queue_score("entry").alias("score"),
    )


def candidate_products(spark: SparkSession, sf: str) -> DataFrame:
    sim = similarity.content_similarity(src.products(spark, sf))
    latest = online.latest_per_user(_log_ratings(spark, sf))
    return online.candidates(latest, sim, _all_ratings(spark, sf)).select(
        "userId", "productId", six("score"), "rank"
    )


def _stored_similarity(spark: SparkSession, sf: str) -> similarity.Similarity:
    """Content similarity as a table: the re-ranker reads it in two places, a stream in every batch."""
    return similarity.stored(similarity.content_similarity(src.products(spark, sf)), run_dir(spark, "similarity"))


def _reranked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sim = _stored_similarity(spark, sf)
    rated = _all_ratings(spark, sf)
    latest = online.latest_per_user(_log_ratings(spark, sf))
    return latest, online.rerank(latest, online.recent_ratings(rated), sim, rated)


def online_rerank(spark: SparkSession, sf: str) -> DataFrame:
    return _reranked(spark, sf)[1].select("userId", "productId", six("score"), "rank")


# --- streams ----------------------------------------------------------------------------


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = src.table(spark, sf, "events").schema
    # A pattern, because a file stream takes a plain path for a folder and this may be one file.
    return src.log_lines(streams.file_stream(spark, f"{sf}/event[s].parquet", layout))


def stream_rating_filter(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "filter")
    lines = _log_stream(spark, sf)
    pipelines.filter_log(
        lines, "parquet", f"{root}/checkpoint", every=None, path=f"{root}/messages"
    ).awaitTermination()
    return spark.read.schema("value string").parquet(f"{root}/messages")


def stream_topic_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The log filter from a topic of two partitions: half of it, then from the checkpoint what came since."""
    root = run_dir(spark, "topic")
    lines = src.log(spark, sf)
    late = F.pmod(F.hash("value"), F.lit(2)) == 1
    for part in (lines.where(~late), lines.where(late)):
        topics.append(part, f"{root}/topic", 2)
        stream = topics.topic_stream(spark, f"{root}/topic", "earliest").select("value")
        pipelines.filter_log(stream, "parquet", f"{root}/checkpoint", every=None, path=f"{root}/messages").awaitTermination()
    return spark.read.schema("value string").parquet(f"{root}/messages")


def stream_recency_queue(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "recency")
    table = KeyedTable(spark, f"{root}/queues", schemas.QUEUES, "userId")
    messages = loglines.rating_lines(_log_stream(spark, sf))
    pipelines.keep_queues(messages, table, f"{root}/checkpoint", every=None).awaitTermination()
    queue = F.arrays_zip("productIds", "scores", "timestamps")
    return table.read().select("userId", F.posexplode(queue).alias("pos", "q")).select(
        "userId", (F.col("pos") + 1).alias("rank"), F.col("q.productIds").alias("productId"),
        F.col("q.scores").alias("score"), F.col("q.timestamps").alias("timestamp"),
    )


def stream_rerank_upsert(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "rerank")
    sim = _stored_similarity(spark, sf)
    job = pipelines.Reranker(spark, src.ratings(spark, sf), sim, root)
    messages = loglines.rating_lines(_log_stream(spark, sf))
    job.start(messages, f"{root}/checkpoint", every=None).awaitTermination()
    return rc.explode_recs(job.recs.read(), "userId").select("userId", "rank", "productId", six("score"))


# --- updates and look-ups ---------------------------------------------------------------


def rating_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return serving.rate_products(src.rating_requests(spark, sf), src.ratings(spark, sf)).ratings


def rating_queues(spark: SparkSession, sf: str) -> DataFrame:
    """Recency queues of the users who posted, after their posts."""
    return serving.rate_products(src.rating_requests(spark, sf), src.ratings(spark, sf)).queues


def rating_exists(spark: SparkSession, sf: str) -> DataFrame:
    requests = upserts.from_requests(src.rating_requests(spark, sf))
    return upserts.already_rated(requests, src.ratings(spark, sf))


def user_prefs_update(spark: SparkSession, sf: str) -> DataFrame:
    """Users who rated through the log are no longer new and prefer the categories they rated."""
    genres = (
        _log_ratings(spark, sf)
        .join(src.products(spark, sf).select("productId", "categories"), "productId")
        .groupBy("userId")
        .agg(F.array_sort(F.collect_set("categories")).alias("prefGenres"))
        .select("userId", F.lit(False).alias("first"), "prefGenres")
    )
    return upserts.update_preferences(src.users(spark, sf), genres).select(
        "userId", "username", "first", F.array_join("prefGenres", "|").alias("prefGenres")
    )


def _averages(spark: SparkSession, sf: str) -> DataFrame:
    return stats.average_scores(src.ratings(spark, sf))


def _detail(rows: DataFrame, *lead: str) -> DataFrame:
    return rows.select(*lead, "productId", "name", "imageUrl", "categories", "tags", six("avg"))


def hot_products(spark: SparkSession, sf: str) -> DataFrame:
    counts = stats.most_rated_by_period(src.ratings(spark, sf))
    return _detail(
        serving.hot_products(counts, src.products(spark, sf), _averages(spark, sf), TOP), "yearmonth", "count"
    )


def rate_more_details(spark: SparkSession, sf: str) -> DataFrame:
    counts = stats.most_rated(src.ratings(spark, sf))
    return _detail(
        serving.most_rated_products(counts, src.products(spark, sf), _averages(spark, sf), TOP), "count"
    )


def _logged_products(spark: SparkSession, sf: str) -> DataFrame:
    return _log_ratings(spark, sf).select("productId").distinct()


def product_info(spark: SparkSession, sf: str) -> DataFrame:
    return _detail(
        serving.product_info(_logged_products(spark, sf), src.products(spark, sf), _averages(spark, sf))
    )


def product_search(spark: SparkSession, sf: str) -> DataFrame:
    return _detail(serving.search_products(src.products(spark, sf), _averages(spark, sf), "blue|ring"))


#: Patterns with one literal, several, a part of one, and none.
PATTERNS = ("blue|ring", "^large.*(plate|anvil)$", "(small )+bolt", "g[a-i]zmo", "ol")


def product_search_index(spark: SparkSession, sf: str) -> DataFrame:
    """Products by pattern, found through the trigrams of their names."""
    path = run_dir(spark, "trigrams")
    products, averages = src.products(spark, sf), _averages(spark, sf)
    name_search.save(name_search.postings(products, "productId", "name"), path)
    posted = spark.read.schema("trigram string, id bigint").parquet(path)
    found = [
        _detail(serving.search_by_index(products, posted, averages, p).withColumn("pattern", F.lit(p)), "pattern") for p in PATTERNS
    ]
    return reduce(DataFrame.unionByName, found)


def user_recs_point(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of the vectors that label 0 names, looked up in a table sorted by user."""
    path = run_dir(spark, "user-recs")
    factors = src.vectors(spark, sf)
    lists = rc.as_recs(dense.top_products(factors, factors, TOP), "userId", "productId", "score")
    tables.save_for_look_up(lists, path, "userId")
    asked = src.table(spark, sf, "embeddings").where("label = 0").select(F.col("vec_id").alias("userId"))
    stored = spark.read.schema(schemas.USER_RECS).parquet(path)
    rows = serving.recommendations_of(asked, stored, src.products(spark, sf), _averages(spark, sf), TOP)
    return _detail(rows.withColumn("score", six("score")), "userId", "rank", "score")


def itemcf_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    lists = itemcf.rec_table(itemcf.top_similar(src.ratings(spark, sf), TOP))
    rows = serving.product_neighbours(
        lists, _logged_products(spark, sf), src.products(spark, sf), _averages(spark, sf), NEIGHBOURS
    )
    return _detail(rows.withColumn("score", six("score")), "forProduct", "rank", "score")


def content_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    products = src.products(spark, sf)
    top = similarity.top_similar(
        similarity.content_similarity(products), _logged_products(spark, sf), NEIGHBOURS
    )
    lists = rc.as_recs(top, "productId", "simProductId", "score")
    rows = serving.product_neighbours(lists, None, products, _averages(spark, sf), NEIGHBOURS)
    return _detail(rows.withColumn("score", six("score")), "forProduct", "rank", "score")


def user_recs_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Positive predictions over all products, twenty per user, found by user name and joined to products."""
    factors = src.vectors(spark, sf)
    lists = rc.as_recs(dense.top_products(factors, factors, TOP), "userId", "productId", "score")
    users = src.users(spark, sf)
    rows = serving.user_recommendations(users, users, lists, src.products(spark, sf), _averages(spark, sf), TOP)
    return _detail(rows.withColumn("score", six("score")), "username", "rank", "score")


def stream_recs_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lists = online.rerank_lists(*_reranked(spark, sf))
    users = src.users(spark, sf)
    rows = serving.user_recommendations(
        users, users, lists, src.products(spark, sf), _averages(spark, sf), NEIGHBOURS
    )
    return _detail(rows.withColumn("score", six("score")), "username", "rank", "score")


def username_hash(spark: SparkSession, sf: str) -> DataFrame:
    return src.users(spark, sf).select("username", fn.user_id("username").alias("userId"))


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    documents = src.products(spark, sf).select(F.to_json(F.struct("*")).alias("json"))
    back = documents.select("json", F.from_json("json", schemas.PRODUCT).alias("p"))
    return back.select("json", "p.*")


def load_products_text(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "products")
    files.write_lines(files.product_lines(src.products(spark, sf)), path)
    return files.read_products(spark, path).rows


def load_ratings_csv(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "ratings")
    src.ratings(spark, sf).write.csv(f"{root}/csv")
    store = tables.Warehouse(spark, f"{root}/tables")
    store.load(src.products(spark, sf), files.read_ratings(spark, f"{root}/csv").rows)
    return store.read("Rating")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        rate_more_products, rate_more_recently, average_products, top5_average, distinct_users_products,
        statistics_kept,
        itemcf_top20, itemcf_recs_list, sim_map_lookup, vector_cosine_pairs, vector_groups, factor_scores_top20,
        tfidf_terms, content_groups, content_similar, content_ranked_groups, content_top20,
        content_similar_hashed, content_similar_md5,
        rmse_eval, grid_argmin, als_recommend, als_item_similarity, als_checks, als_best_checks, als_grid_search, als_grid_checks,
        rating_log_filter, rating_log_parse, rating_log_rejects, rating_log_lines,
        recent_ratings_per_user, candidate_products, online_rerank,
        stream_rating_filter, stream_topic_filter, stream_recency_queue, stream_rerank_upsert,
        rating_upsert, rating_queues, rating_exists, user_prefs_update,
        hot_products, rate_more_details, product_info, product_search, product_search_index, user_recs_point,
        itemcf_neighbours, content_neighbours, user_recs_lookup, stream_recs_lookup,
        username_hash, json_roundtrip, load_products_text, load_ratings_csv,
    )
}
