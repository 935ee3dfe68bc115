"""Keyed state: expiry at local midnight, the roll-up for any split, metrics of long runs."""

import random

import pytest
from pyspark.sql import functions as F

from rillet.operators.dedup import event_rollup
from rillet.sources.day_table import append_batch
from rillet.streaming import state
from rillet.streaming.metrics import LATE, StageMetrics

NOW = {"availableNow": True}
HOUR = 3_600_000
DAY = 24 * HOUR


def test_next_midnight():
    assert state.next_midnight(0, "UTC") == DAY
    assert state.next_midnight(DAY - 1, "UTC") == DAY
    assert state.next_midnight(DAY, "UTC") == 2 * DAY
    assert state.next_midnight(0, "Asia/Shanghai") == 16 * HOUR
    # the day on which clocks go forward has 23 hours: 2024-03-31 in Berlin
    assert state.next_midnight(1711839600000, "Europe/Berlin") - 1711839600000 == 23 * HOUR


def drive(spark, root, batches, schema, make, mode="append"):
    """Deliver batches one after another on one checkpoint; (batch, row) put out, states."""
    src, left = f"{root}/src", []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        query = state.start(make(spark.readStream.schema(schema).parquet(src)),
                            lambda df, k: append_batch(df, f"{root}/out", k), f"{root}/ckpt", NOW, mode, 2)
        query.awaitTermination()
        assert query.exception() is None
        left.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    return spark.read.parquet(f"{root}/out"), left


def test_midnight_expiry(spark, scratch):
    def row(mid, at, last=None):
        return mid, last, at
    batches = [[row("a", 1), row("a", 5), row("b", 7), row("c", 8, "home")],
               [row("a", DAY - 1), row("b", DAY - 2)],       # before midnight: seen already
               [row("a", DAY), row("a", DAY + 9), row("b", 2 * DAY + 1)],  # after it, twice
               [row(None, 4 * DAY)], [row(None, 5 * DAY)]]
    out, left = drive(spark, scratch, batches, "mid string, last_page_id string, ts bigint",
                      lambda s: state.midnight_active_stream(s, F.col("ts")))
    got = sorted((r.mid, r.seen) for r in out.collect())
    assert got == [("a", 1), ("a", DAY), ("b", 7), ("b", 2 * DAY + 1)]
    assert left[1] > 0 and left[-1] == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_rollup_equals_the_batch_for_any_split(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([1, 2, None]), rng.choice(["x", "y", None]), 10 * DAY + rng.randrange(0, 20) * HOUR // 4,
             rng.choice([None, 1.0, -2.0, 5.5])) for k in range(120)]
    schema = "event_id bigint, user_id bigint, event_type string, ts bigint, value double"
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(len(rows)), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    batches.append([(-1, -1, None, 15 * DAY, None)])  # moves the watermark past all of them
    out, _ = drive(spark, scratch, batches, schema,
                   lambda s: state.rollup_stream(s, "user_id", "event_type", "ts", "value", "event_id", "2 days"),
                   "update")
    last = out.groupBy("k", "start_time", "start_tie").agg(F.max_by(F.struct("*"), "n_rows").alias("r"))
    cols = ["event", "start_time", "end_time", "start_value", "end_value", "min_value", "max_value", "n_rows"]
    got = last.select(F.from_json("k", "key bigint")["key"].alias("user_id"),
                      *[F.col(f"r.{c}") for c in cols]).where("not user_id <=> -1")
    want = event_rollup(spark.createDataFrame(rows, schema), "user_id", "event_type", "ts", "value", "event_id")
    want = want.withColumnRenamed("event_type", "event").select("user_id", *cols)

    def plain(df):
        return sorted(map(tuple, df.collect()), key=repr)
    assert plain(got) == plain(want)


def test_metrics_beyond_the_progress_a_query_keeps(spark, scratch):
    schema, src = "id bigint", f"{scratch}/src"
    spark.range(110).repartitionByRange(110, "id").write.parquet(src)
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        with StageMetrics(spark, f"{scratch}/metrics") as metrics:
            rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
            query = (rows.observe("parsed", F.count(F.lit(1)).alias("rows")).writeStream.format("noop")
                     .option("checkpointLocation", f"{scratch}/ckpt").trigger(**NOW).start())
            query.awaitTermination()
            metrics.settle()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
    assert len(query.recentProgress) <= 10
    found = {r.stage: (r.n, r.rows) for r in metrics.read().groupBy("stage").agg(
        F.count_distinct("batch").alias("n"), F.sum("rows").alias("rows")).collect()}
    assert found["parsed"][1] == 110 and found["parsed"][0] >= 100
    assert found[LATE][1] == 0
