"""Topics by offset: where a first start begins, ranges of a batch, resuming, odd rows."""

import json

import pytest

from rillet.sources import topic_log
from rillet.sources.topic_log import TopicReader, topic_stream, write_records

NOW = {"availableNow": True}


def records(spark, *rows):
    return spark.createDataFrame(list(rows), topic_log.SCHEMA)


@pytest.fixture()
def topics(spark, scratch):
    write_records(records(spark, *[("t", p, o, f"k{o}", None if o == 3 else "v")
                                   for p in (0, 1) for o in range(5 + p)], ("u", 0, 9, "k", "v")),
                  f"{scratch}/topics")
    return f"{scratch}/topics"


def run(spark, topics, root, starting, **options):
    stream = topic_stream(spark, topics, "t", starting, **options)
    (stream.writeStream.format("parquet").option("path", f"{root}/out")
     .option("checkpointLocation", f"{root}/ckpt").trigger(**NOW).start().awaitTermination())
    out = spark.read.schema(topic_log.SCHEMA).parquet(f"{root}/out")
    return sorted((r["partition"], r["offset"]) for r in out.collect())


def test_first_offsets(topics):
    def first(starting):
        return TopicReader(topics, "t", starting, 10).initialOffset()
    assert first("latest") == {"0": 5, "1": 6}
    assert first("earliest") == {"0": 0, "1": 0}
    assert first('{"0": 2}') == {"0": 2, "1": 0}
    assert first('{"t": {"0": -1, "1": -2, "7": 4}}') == {"0": 5, "1": 0, "7": 4}
    assert TopicReader(topics, "none", "latest", 10).initialOffset() == {}
    assert TopicReader(f"{topics}/nowhere", "t", "latest", 10).latestOffset() == {}


def test_a_hot_partition_is_many_ranges(topics):
    reader = TopicReader(topics, "t", "earliest", 2)
    parts = reader.partitions({"0": 1, "1": 6}, reader.latestOffset())
    assert [(p.partition, p.start, p.end) for p in parts] == [(0, 1, 3), (0, 3, 5)]
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["offset"], r["value"]) for r in rows] == [(1, "v"), (2, "v"), (3, None), (4, "v")]
    assert reader.partitions({"0": 5, "1": 6}, {"0": 5, "1": 6}) == []


def test_resumes_exactly_and_takes_new_partitions(spark, topics, scratch):
    start = json.dumps({"0": 3})
    want = [(0, 3), (0, 4), *[(1, o) for o in range(6)]]
    assert run(spark, topics, scratch, start, rows_per_task=2) == want
    assert run(spark, topics, scratch, start) == want  # nothing new, and not from 3 again
    write_records(records(spark, ("t", 0, 7, None, "gap"), ("t", 2, 4, "k", None)), topics)
    assert run(spark, topics, scratch, "latest") == sorted([*want, (0, 7), (2, 4)])


def test_no_topic_yet(spark, scratch):
    assert run(spark, f"{scratch}/topics", scratch, "earliest") == []
    write_records(records(spark, ("t", 0, 0, "k", "v")), f"{scratch}/topics")
    assert run(spark, f"{scratch}/topics", scratch, "earliest") == [(0, 0)]
