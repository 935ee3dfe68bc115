"""Stateful streaming replays: expiry at midnight, roll-up, metrics of every batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.time import day_of
from rillet.plans import streams
from rillet.plans.documents import rollup_events
from rillet.session import scratch_path
from rillet.sources import adapters
from rillet.sources.day_table import append_batch
from rillet.streaming import state
from rillet.streaming.metrics import StageMetrics
from rillet.streaming.sources import file_stream, replay, time_chunks, written

ZONE = "Asia/Shanghai"
DAY_MS = 86_400_000
#: Hours by which the roll-up's rows come late, by id, and the delay that covers them.
LATE_HOURS, DELAY = 7, "8 hours"


def _state_rows(query) -> int:
    """Rows that the state of the query's last batch holds."""
    found = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    return found[-1] if found else 0


def stream_midnight_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A device counts again after local midnight of the clock and not before; two days
    after the last row its state is gone. The clock of the replay is the rows' own time."""
    root = scratch_path(spark, "stream-midnight")
    pages = written(adapters.page_log(spark, sf_dir, province=False).select("mid", "last_page_id", "ts"),
                    f"{root}/pages")
    src, left = f"{root}/src", []

    def run_once():
        stream = state.midnight_active_stream(file_stream(spark, src, pages.schema), F.col("ts"), ZONE)
        query = state.start(stream, lambda df, k: append_batch(df, f"{root}/out", k), f"{root}/ckpt",
                            streams.AVAILABLE_NOW, partitions=streams._state_partitions(spark))
        query.awaitTermination()
        left.append(_state_rows(query))
        return query
    newest = pages.agg(F.max("ts")).first()[0] or 0
    later = [spark.createDataFrame([(None, None, newest + n * DAY_MS)], pages.schema)
             for n in (2, 4)]  # rows of no device move the clock on
    replay([[(src, chunk)] for chunk in [*time_chunks(pages, "ts", streams.CUTS), *later]], run_once)
    out = spark.read.schema("mid string, seen bigint").parquet(f"{root}/out").where("mid is not null")
    return out.select(day_of("seen", ZONE).alias("dt"), "mid", F.lit(max(left[:-1]) > 0).alias("held"),
                      F.lit(left[-1]).cast("bigint").alias("devices_left"))


def stream_event_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up while the rows come in, in four parts and up to seven hours late."""
    root = scratch_path(spark, "stream-rollup")
    rows = rollup_events(spark, sf_dir)
    arrival = F.col("ts") + F.coalesce(F.col("event_id"), F.lit(0)) % LATE_HOURS * 3_600_000
    chunks = time_chunks(rows.withColumn("arrival", arrival), "arrival", [0.25, 0.5, 0.75])
    src = f"{root}/src"
    newest = rows.agg(F.max("ts")).first()[0] or 0
    heart = spark.createDataFrame([(-1, None, newest + n * DAY_MS, -1, None) for n in (2,)],
                                  "event_id bigint, value double, ts bigint, user_id bigint, event_type string")

    def run_once():
        stream = state.rollup_stream(file_stream(spark, src, heart.schema), "user_id", "event_type",
                                     "ts", "value", "event_id", DELAY)
        return state.start(stream, lambda df, k: append_batch(df, f"{root}/out", k), f"{root}/ckpt",
                           streams.AVAILABLE_NOW, "update", streams._state_partitions(spark))
    steps = [[(src, c.select(*heart.columns))] for c in chunks] + [[(src, heart)]]
    replay(steps, run_once)
    out = spark.read.schema(f"k string, {state.RUN}, closed boolean").parquet(f"{root}/out")
    last = out.groupBy("k", "start_time", "start_tie").agg(
        F.max_by(F.struct("event", "end_time", "start_value", "end_value", "min_value", "max_value",
                          "n_rows"), "n_rows").alias("r"))
    return last.select(F.from_json("k", "key bigint").getField("key").alias("user_id"), "start_time", "r.*") \
        .withColumnRenamed("event", "event_type").where("not (user_id <=> -1)")


def stream_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 + A12 + W6: rows of each stage over all batches of a running job, as its listener
    stored them batch by batch, and the rows that came too late."""
    root = scratch_path(spark, "stream-metrics")
    with StageMetrics(spark, f"{root}/metrics") as metrics:
        streams._dau_replay(spark, sf_dir, root, lambda chunks: chunks)
        metrics.settle()
    found = metrics.read().groupBy("stage").agg(F.sum("rows").alias("rows"))
    return found.select("stage", "rows")
