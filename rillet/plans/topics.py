"""Queries over topic streams (S1, S2): where a stream starts and where it resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.session import scratch_path
from rillet.sources import topic_log
from rillet.sources.tables import table
from rillet.streaming.sources import cut_at

TOPIC = "ods_base_log"
PARTITIONS = 3
#: First offsets of the explicit start; 2 is not named and starts at its first record.
FIRST = {"0": 40, "1": topic_log.EARLIEST}
AVAILABLE_NOW = {"availableNow": True}


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events as topic records in three parts by their ids."""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "value")
    newest = events.agg(F.max("event_id")).first()[0]
    edges = [] if newest is None else [newest // 3, newest * 2 // 3]
    return [topic_log.event_records(e, TOPIC, PARTITIONS) for e in cut_at(events, "event_id", edges)]


def _run(spark: SparkSession, root: str, starting, trigger: dict):
    """The records of the topic to a folder, on the one checkpoint of ``root``."""
    stream = topic_log.topic_stream(spark, f"{root}/topics", TOPIC, starting)
    return (stream.writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/ckpt").trigger(**trigger).start())


def _read(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.schema(topic_log.SCHEMA).parquet(f"{root}/out")
    return rows.select("topic", "partition", "offset", "key",
                       F.get_json_object("value", "$.event_type").alias("event_type"))


def stream_latest_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream without saved offsets starts at the latest ones: what was there before
    is not read, what comes while it runs is, and after a stop it resumes where it was."""
    root, parts = scratch_path(spark, "stream-latest"), _parts(spark, sf_dir)
    topic_log.write_records(parts[0], f"{root}/topics")
    query = _run(spark, root, "latest", {"processingTime": "0 seconds"})
    query.processAllAvailable()  # it has its first offsets
    for part in parts[1:2]:
        topic_log.write_records(part, f"{root}/topics")
    query.processAllAvailable()
    query.stop()
    for part in parts[2:]:
        topic_log.write_records(part, f"{root}/topics")
    _run(spark, root, "latest", AVAILABLE_NOW).awaitTermination()
    return _read(spark, root)


def stream_explicit_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first start from given offsets, another one for each partition; then a restart
    for what came since, which asks for the same offsets and does not go back to them."""
    root = scratch_path(spark, "stream-offsets")
    for part in _parts(spark, sf_dir):
        topic_log.write_records(part, f"{root}/topics")
        _run(spark, root, {TOPIC: FIRST}, AVAILABLE_NOW).awaitTermination()
    return _read(spark, root)
