import json

from shelfwise.session import run_dir
from shelfwise.sources import topics
from shelfwise.streaming import pipelines


def lines(spark, first, last):
    return spark.createDataFrame([(f"PRODUCT_RATING_PREFIX:{i}|2|3.0|4",) for i in range(first, last)], "value string")


def filtered(spark, root, starting="earliest"):
    stream = topics.topic_stream(spark, f"{root}/topic", starting).select("value")
    pipelines.filter_log(stream, "parquet", f"{root}/checkpoint", every=None, path=f"{root}/out").awaitTermination()
    return sorted(int(r.value.split("|")[0]) for r in spark.read.schema("value string").parquet(f"{root}/out").collect())


def test_append_goes_on_behind_the_offsets(spark):
    path = f"{run_dir(spark, 'topic')}/topic"
    topics.append(lines(spark, 0, 30), path, 2)
    topics.append(lines(spark, 30, 50), path, 2)
    rows = spark.read.schema("offset bigint, value string, partition int").parquet(path).collect()
    for p in (0, 1):
        offsets = sorted(r.offset for r in rows if r.partition == p)
        assert offsets == list(range(len(offsets))) and len(offsets) > 5
    assert len(rows) == 50


def test_restart_at_the_checkpoint_loses_and_doubles_nothing(spark):
    root = run_dir(spark, "topic")
    topics.append(lines(spark, 0, 40), f"{root}/topic", 2)
    assert filtered(spark, root) == list(range(40))
    assert filtered(spark, root) == list(range(40))  # nothing new
    topics.append(lines(spark, 40, 70), f"{root}/topic", 2)
    topics.append(lines(spark, 70, 75), f"{root}/topic", 3)  # a partition more
    assert filtered(spark, root) == list(range(75))


def test_starting_offsets(spark):
    root = run_dir(spark, "topic")
    topics.append(lines(spark, 0, 40), f"{root}/topic", 2)
    ends = topics.TopicReader({"path": f"{root}/topic"}).latestOffset()
    topics.append(lines(spark, 40, 60), f"{root}/topic", 2)
    assert filtered(spark, root, json.dumps(ends)) == list(range(40, 60))
    late = topics.TopicReader({"path": f"{root}/topic"})
    assert late.initialOffset() == late.latestOffset()
    assert late.partitions(late.initialOffset(), late.latestOffset()) == []


def test_an_empty_topic_has_no_offsets(spark):
    assert topics.TopicReader({"path": run_dir(spark, "topic"), "startingOffsets": "earliest"}).initialOffset() == {}
