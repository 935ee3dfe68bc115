"""Stream sources (S1, S2) and the file-replay harness used in tests.

Offsets live in the query's ``checkpointLocation``: a restarted query resumes
after the last committed batch (S2); a first start reads from ``startingOffsets``
(S1 starts at the latest offsets).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from rillet.session import no_shuffle_left

SLICE = "__slice"


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest") -> DataFrame:
    """String key/value records of one topic (needs the Kafka connector
    on the classpath). ``starting_offsets`` may be a per-partition JSON map."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value"),
                    "topic", "partition", "offset"))


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Tested source form: new files under ``path`` become micro-batches."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def cut_at(df: DataFrame, ts_col: str, edges: list) -> list[DataFrame]:
    """Chunks of ``df`` between the edges; rows without a time come with the first."""
    out = []
    for k in range(len(edges) + 1):
        cond = F.lit(True)
        if k > 0:
            cond = cond & (F.col(ts_col) >= F.lit(edges[k - 1]))
        if k < len(edges):
            cond = cond & (F.col(ts_col) < F.lit(edges[k]))
        if k == 0:
            cond = cond | F.col(ts_col).isNull()
        out.append(df.where(cond))
    return out


def time_edges(df: DataFrame, ts_col: str, cuts: list[float]) -> list:
    """Times at fractions ``cuts`` of the [min, max] span of ``ts_col`` (numeric)."""
    row = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    return [] if row["lo"] is None else [row["lo"] + (row["hi"] - row["lo"]) * c for c in cuts]


def time_chunks(df: DataFrame, ts_col: str, cuts: list[float]) -> list[DataFrame]:
    """Split a table into time-ordered chunks; one aggregate row is read."""
    return cut_at(df, ts_col, time_edges(df, ts_col, cuts))


def in_slices(passes: Iterable[DataFrame], ts_col: str, edges: list, path: str) -> list[DataFrame]:
    """The rows of ``passes``, each derived once, in slices of time between the edges: written
    below ``path``, a folder a slice. Rows without a time come with the first."""
    number = reduce(add, [(F.col(ts_col) >= F.lit(e)).cast("int") for e in edges], F.lit(0))
    for rows in passes:
        spark, schema = rows.sparkSession, rows.schema
        sliced = rows.withColumn(SLICE, F.coalesce(number, F.lit(0))).hint("rebalance", SLICE)
        with no_shuffle_left(spark):
            sliced.write.mode("append").option("compression", "zstd").partitionBy(SLICE).parquet(path)
    stored = spark.read.schema(StructType([*schema, StructField(SLICE, IntegerType())])).parquet(path)
    return [stored.where(F.col(SLICE) == k).drop(SLICE) for k in range(len(edges) + 1)]


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path``: rows that are cut into chunks are derived once, not once
    for the edges and once more for every chunk."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replay(steps: list[list[tuple[str, DataFrame]]], run_once: Callable[[], StreamingQuery],
           done: Callable[[int], None] | None = None) -> int:
    """Deliver steps one after another: append each step's chunks to their
    source folders, then run the query to completion (availableNow) on the same
    checkpoint, i.e. a restart per step. ``done`` is told of each run that ended.
    Returns the number of runs."""
    runs = 0
    for step in steps:
        for path, chunk in step:
            chunk.write.mode("append").parquet(path)
        q = run_once()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if done is not None:
            done(runs)
        runs += 1
    return runs
