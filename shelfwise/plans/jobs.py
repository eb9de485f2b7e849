"""The batch and streaming jobs over a warehouse folder.

    python -m shelfwise.plans.jobs <job> --root <folder> [options]

Jobs hand over through tables: ``load`` writes Product and Rating; ``statistics``, ``itemcf``,
``content`` and ``search`` read them; ``offline`` reads the parameters ``search`` found; ``rate`` takes rating
posts; ``rerank`` reads a stored similarity, ``Content`` or ``Product``.

``--num`` is the length of every list a job writes.  Without it ``itemcf`` and the user lists take their usual
twenty, while similar products are stored whole: ranked group pairs, one row each, and the members of the groups.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfwise import schemas
from shelfwise.operators import als, itemcf, similarity, stats, upserts
from shelfwise.operators import recs as rc
from shelfwise.operators.similarity import Similarity
from shelfwise.plans import serving
from shelfwise.session import build_session, clean_runs
from shelfwise.sources import files, streams
from shelfwise.sources.keyed import KeyedTable
from shelfwise.sources.tables import BUCKETS, Warehouse
from shelfwise.streaming import pipelines


def load(store: Warehouse, products_path: str, ratings_path: str, buckets: int = BUCKETS) -> None:
    """Text files -> Product and Rating; lines that do not parse go to the reject tables."""
    products = files.read_products(store.spark, products_path)
    ratings = files.read_ratings(store.spark, ratings_path)
    store.load(products.rows, ratings.rows, buckets)
    store.overwrite("ProductRejects", products.rejects)
    store.overwrite("RatingRejects", ratings.rejects)


def statistics(store: Warehouse, pattern: str = stats.MONTH) -> None:
    """From the totals that ``load`` and ``rate`` keep up to date; another period than months reads the ratings."""
    known = store.read("RatingTotals")
    store.overwrite("RateMoreProducts", stats.most_rated_of(known))
    by_period = stats.most_rated_by_month_of(known) if pattern == stats.MONTH else stats.most_rated_by_period(store.read("Rating"), pattern)
    store.overwrite("RateMoreRecentlyProducts", by_period)
    store.overwrite("AverageProducts", stats.average_scores_of(known))


def item_lists(store: Warehouse, k: int = itemcf.TOP) -> None:
    store.overwrite("ItemCFProductRecs", itemcf.rec_table(itemcf.top_similar(store.read("Rating"), k)))


def _store_similarity(store: Warehouse, sim: Similarity, prefix: str) -> Similarity:
    store.overwrite(f"{prefix}Groups", sim.members)
    store.overwrite(f"{prefix}GroupPairs", sim.pairs)
    return stored_similarity(store, prefix)


def stored_similarity(store: Warehouse, prefix: str) -> Similarity:
    return Similarity(store.read(f"{prefix}Groups"), store.read(f"{prefix}GroupPairs"))


def _store_lists(store: Warehouse, sim: Similarity, prefix: str, name: str, k: int | None) -> None:
    """Everything above the threshold as ranked group pairs; also lists of the k best if k is given."""
    store.overwrite(f"{prefix}RankedGroups", similarity.ranked_groups(sim))
    if k is not None:
        top = similarity.top_similar(sim, sim.members, k)
        store.overwrite(name, rc.as_recs(top, "productId", "simProductId", "score"))


def content(store: Warehouse, k: int | None = None) -> None:
    sim = _store_similarity(store, similarity.content_similarity(store.read("Product")), "Content")
    _store_lists(store, sim, "Content", "ContentBasedProductRecs", k)


def search(
    store: Warehouse, ranks=als.RANKS, iterations=als.ITERATIONS, lambdas=als.LAMBDAS, parallelism: int = als.PARALLEL_FITS
) -> None:
    """Parameter grid on a 75/25 split -> the winner in OptedParams."""
    train, test = als.split(store.read("Rating"))
    store.overwrite("OptedParams", als.best(als.grid_search(train, test, ranks, iterations, lambdas, parallelism)))


def offline(store: Warehouse, k: int = als.USER_LIST, whole: bool = False) -> None:
    """Fit with the stored parameters -> user lists, similar products, k of each.

    Nearly all factor pairs may lie above the threshold, so only ``whole`` stores that table, which grows with the
    square of the catalogue; the re-ranker needs it if it is to use factor similarity.
    """
    model = als.fit_best(store.read("Rating"), store.read("OptedParams"))
    store.overwrite("UserRecs", als.user_recs(model, k))
    if whole:
        sim = _store_similarity(store, als.item_similarity(model), "Product")
    else:
        sim = als.top_items(model, k)
        store.overwrite("ProductGroups", sim.members)
    _store_lists(store, sim, "Product", "ProductRecs", k)


def rate(store: Warehouse, posts: DataFrame, batch: int | None = None) -> list[int]:
    """Rating posts (userId, productId, uiScore, timestamp) -> Rating, the users' queues, log lines; gives the buckets written.

    Only the folders of the posting users are read and written.  With a ``batch`` number a job that was lost while
    its folders were moved in can be run again.
    """
    ratings = store.ratings_by_user()
    touched = ratings.buckets_of(posts)
    theirs = ratings.rows_in(touched)
    done = serving.rate_products(posts, theirs)
    store.overwrite("RatingLog", done.log)
    # Stored before the ratings change, because the lists are computed from them.
    store.overwrite("RatingQueuesNext", done.queues)
    store.keyed("RatingQueues").replace(store.read("RatingQueuesNext", schemas.RATING_QUEUES), batch)
    # Only the posted pairs change, so that the result does not depend on who shares a folder.  Their rows are stored before
    # and after, and the others go from the table to the stage of ``rewrite`` and nowhere else.
    changes = upserts.from_requests(posts)
    store.overwrite("RatingBefore", upserts.named_rows(theirs, changes))
    before = store.read("RatingBefore", schemas.RATING)
    store.overwrite("RatingNext", upserts.upsert_ratings(before, changes))
    after = store.read("RatingNext", schemas.RATING)
    # Totals first: what they change by is computed from the ratings before the change.  A batch that is run again after
    # its totals were staged takes them from there.
    store.add_totals(stats.change(before, after), batch)
    ratings.rewrite(touched, upserts.other_rows(theirs, changes).unionByName(after), batch)
    return touched


def stream_recs(store: Warehouse) -> KeyedTable:
    """StreamRecs: what the re-ranker writes and look-ups read (``.read()``, or ``.read(users)``)."""
    return store.keyed("StreamRecs")


def rerank(
    store: Warehouse, messages: DataFrame, root: str, prefix: str = "Content", every: str | None = "2 seconds"
) -> tuple[pipelines.Reranker, list[StreamingQuery]]:
    """Lists go to StreamRecs, messages that do not parse to a folder of rejects."""
    sim = stored_similarity(store, prefix)
    job = pipelines.Reranker(store.spark, store.read("Rating"), sim, root, stream_recs(store))
    rejects = pipelines.keep_rejects(messages, f"{root}/rejects", f"{root}/rejects-checkpoint", every)
    return job, [job.start(messages, f"{root}/checkpoint", every), rejects]


def show_hot(store: Warehouse, num: int) -> None:
    serving.hot_products(
        store.read("RateMoreRecentlyProducts"), store.read("Product"), store.read("AverageProducts"), num
    ).show(num, truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfwise")
    parser.add_argument(
        "job",
        choices=["load", "statistics", "itemcf", "content", "search", "offline", "rate", "filter", "rerank", "hot"],
    )
    parser.add_argument("--root", required=True, help="warehouse folder on shared storage")
    parser.add_argument("--format", default="parquet", help="data source of the tables")
    parser.add_argument("--products")
    parser.add_argument("--ratings")
    parser.add_argument("--pattern", default="yyyyMM")
    parser.add_argument("--num", type=int, help="length of lists")
    parser.add_argument("--whole", action="store_true", help="offline: store all factor pairs above the threshold")
    parser.add_argument("--parallelism", type=int, default=als.PARALLEL_FITS, help="search: fits at a time")
    parser.add_argument("--similarity", default="Content", help="rerank: Content or Product (after offline --whole)")
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="load: user folders of Rating")
    parser.add_argument("--batch", type=int, help="rate: number of the batch of posts, the same when it is run again")
    parser.add_argument("--posts", help="rate: folder of Parquet posts")
    parser.add_argument("--brokers")
    parser.add_argument("--source", help="topic with --brokers, else a folder of text files")
    parser.add_argument("--sink", help="topic with --brokers, else a folder")
    args = parser.parse_args(argv)

    spark = build_session(f"shelfwise-{args.job}")
    store = Warehouse(spark, args.root, args.format)
    if args.job in ("filter", "rerank"):
        lines = (
            streams.kafka_lines(spark, args.brokers, args.source)
            if args.brokers
            else streams.text_stream(spark, args.source)
        )
        checkpoint = f"{args.root}/_streams/{args.job}"
        if args.job == "rerank":
            rerank(store, lines, checkpoint, args.similarity)
            spark.streams.awaitAnyTermination()
        elif args.brokers:
            options = {"kafka.bootstrap.servers": args.brokers, "topic": args.sink}
            pipelines.filter_log(lines, "kafka", checkpoint, **options).awaitTermination()
        else:
            pipelines.filter_log(lines, "text", checkpoint, path=args.sink).awaitTermination()
        return
    {
        "load": lambda: load(store, args.products, args.ratings, args.buckets),
        "statistics": lambda: statistics(store, args.pattern),
        "itemcf": lambda: item_lists(store, args.num or itemcf.TOP),
        "content": lambda: content(store, args.num),
        "search": lambda: search(store, parallelism=args.parallelism),
        "offline": lambda: offline(store, args.num or als.USER_LIST, args.whole),
        "rate": lambda: rate(store, spark.read.parquet(args.posts), args.batch),
        "hot": lambda: show_hot(store, args.num or 20),
    }[args.job]()
    clean_runs(spark)


if __name__ == "__main__":
    main()
