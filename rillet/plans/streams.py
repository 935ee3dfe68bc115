"""Streaming queries replayed over the test tables.

Inputs are written as files in time order, chunk by chunk, and the streaming job
is restarted on the same checkpoint after each chunk (availableNow). The result
is the sink's final content, read back as a batch DataFrame. Scratch folders live
under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillet.functions.json import parse
from rillet.plans.routes import digest_of_value
from rillet.schemas import CDC_RECORD
from rillet.session import drop_path, release_shuffles, scratch_path
from rillet.sources import adapters
from rillet.sources.day_table import DayTable
from rillet.streaming import jobs
from rillet.streaming.metrics import LATE, StageMetrics
from rillet.streaming.sources import SLICE, file_stream, in_slices, replay, time_chunks, time_edges, written

CUTS = [0.33, 0.66]  # chunk edges as fractions of the time span (split inside days)
#: Seconds by which order lines arrive before or after the step of their order.
SHIFT_S = 6 * 3600
#: Slices of a replay's orders for each pass of their derivation.
SLICES_A_PASS = 2
AVAILABLE_NOW = {"availableNow": True}
#: Rows of the fact topics.
FACTS = "key string, value string, seq bigint, batch_id int, topic string"


def _state_partitions(spark) -> int:
    """State-store partitions of the replayed queries: the cluster's parallelism."""
    return spark.sparkContext.defaultParallelism


def _dims(spark, sf_dir):
    return (lambda: adapters.user_info(spark, sf_dir),
            lambda: adapters.base_province(spark, sf_dir))


def _dau_replay(spark, sf_dir, root, steps_of, rebuild=False, ckpt_name="ckpt"):
    pl = written(adapters.page_log(spark, sf_dir), f"{root}/pages")
    src = f"{root}/src"
    sink = DayTable(spark, f"{root}/sink", ["dt", "mid"], ["dt"])
    users, provinces = _dims(spark, sf_dir)

    def run_once():
        stream = file_stream(spark, src, pl.schema)
        return jobs.dau_stream(stream, users, provinces, sink, f"{root}/{ckpt_name}",
                               adapters.USER_AS_OF, trigger=AVAILABLE_NOW, state_partitions=_state_partitions(spark),
                               rebuild_from_sink=rebuild)
    chunks = time_chunks(pl, "ts", CUTS)
    replay([[(src, c)] for c in steps_of(chunks)], run_once)
    return sink, pl, src, run_once


def stream_dau_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-dau")
    sink, *_ = _dau_replay(spark, sf_dir, root, lambda c: c)
    return sink.read().select("dt", "mid", "user_gender", "user_age", "province_name")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three restarts, then the last chunk delivered a second time and
    one more run with nothing new; the sink must equal the batch answer."""
    root = scratch_path(spark, "stream-restart")
    sink, pl, src, run_once = _dau_replay(spark, sf_dir, root, lambda c: c + [c[-1]])
    run_once().awaitTermination()
    return sink.read().groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def state_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the first two chunks run with one checkpoint; the state is then lost
    (new checkpoint) and chunks two and three arrive; repeats are recognised
    from the sink instead of the state."""
    root = scratch_path(spark, "stream-rebuild")
    sink, pl, src, _ = _dau_replay(spark, sf_dir, root, lambda c: c[:2])
    chunks = time_chunks(pl, "ts", CUTS)  # one of an empty table
    users, provinces = _dims(spark, sf_dir)

    def run_fresh():
        stream = file_stream(spark, src, pl.schema)
        return jobs.dau_stream(stream, users, provinces, sink, f"{root}/ckpt-rebuilt",
                               adapters.USER_AS_OF, trigger=AVAILABLE_NOW, state_partitions=_state_partitions(spark),
                               rebuild_from_sink=True)
    replay([[(src, chunk) for chunk in chunks[1:]]], run_fresh)
    return sink.read().groupBy("dt", "mid").agg(F.count(F.lit(1)).alias("copies"))


def _order_slices(spark, sf_dir, root) -> list[list[DataFrame]]:
    """Orders and their lines in slices of time, pairs in the order of their delivery: three
    steps, each in as many slices as the input asks for, so that what the join holds and what a
    run writes do not grow with it. Around the first cut lines come a step before their order,
    around the second a step after it: the join holds either side over the restart."""
    def timed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__t", F.to_timestamp("create_time").cast("long"))
    parts = adapters.order_passes(spark, sf_dir)
    each = -(-len(parts) * SLICES_A_PASS // 3) if len(parts) > 1 else 1
    bounds = [0.0, *CUTS, 1.0]
    cuts = [lo + (hi - lo) * k / each for lo, hi in zip(bounds, bounds[1:]) for k in range(each)][1:]
    edges = time_edges(timed(adapters.order_info(spark, sf_dir)), "__t", cuts) or [0] * len(cuts)
    line_edges = list(edges)
    line_edges[each - 1] += SHIFT_S
    line_edges[2 * each - 1] -= SHIFT_S
    sides = [in_slices((timed(of(spark, sf_dir, part=p)) for p in parts), "__t", at, f"{root}/{name}")
             for of, at, name in ((adapters.order_info, edges, "all-orders"),
                                  (adapters.order_detail, line_edges, "all-details"))]
    return [[side.drop("__t") for side in pair] for pair in zip(*sides)]


def stream_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-orders")
    slices = _order_slices(spark, sf_dir, root)
    o_src, d_src = f"{root}/orders", f"{root}/details"
    sink = DayTable(spark, f"{root}/sink", ["detail_id"], ["create_date"])
    users, provinces = _dims(spark, sf_dir)
    o_schema, d_schema = (rows.schema for rows in slices[0])

    def run_once():
        o = file_stream(spark, o_src, o_schema)
        d = file_stream(spark, d_src, d_schema)
        return jobs.order_join_stream(o, d, users, provinces, sink, f"{root}/ckpt",
                                      adapters.USER_AS_OF, trigger=AVAILABLE_NOW,
                                      state_partitions=_state_partitions(spark))

    def done(k: int) -> None:
        # what a run has taken is in the sink or in its state: its records are not read again
        for path in (o_src, d_src, f"{root}/all-orders/{SLICE}={k}", f"{root}/all-details/{SLICE}={k}"):
            drop_path(spark, path)
        release_shuffles(spark)
    replay([[(o_src, o), (d_src, d)] for o, d in slices], run_once, done)
    return sink.read().select("detail_id", "order_id", "create_date", "user_gender",
                              "province_name",
                              F.col("split_total_amount").cast("double").alias("split_total_amount"))


def _routed(spark, sf_dir, root: str) -> str:
    """Run the log router over the raw records in three steps; the output folder."""
    raw = adapters.raw_log_json(spark, sf_dir)
    src, out = f"{root}/src", f"{root}/out"

    def run_once():
        stream = file_stream(spark, src, raw.schema)
        return jobs.log_router(stream, out, f"{root}/ckpt", trigger=AVAILABLE_NOW,
                               state_partitions=_state_partitions(spark))
    replay([[(src, c)] for c in time_chunks(raw, "seq", CUTS)], run_once)
    return out


def stream_log_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _routed(spark, sf_dir, scratch_path(spark, "stream-log"))
    parts = [spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("route"), "rows") for name in jobs.LOG_ROUTES]
    return reduce(DataFrame.unionByName, parts)


def log_route_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + W2: what the route tables hold, row by row."""
    out = _routed(spark, sf_dir, scratch_path(spark, "stream-log-rows"))
    what = {"error": ("null", "null", "get_json_object(err, '$.error_code')"),
            "page": ("mid", "ts", "page_id"), "action": ("mid", "action_ts", "action_id"),
            "display": ("mid", "ts", "display_item"), "start": ("mid", "ts", "open_ad_id")}
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{out}/{name}").selectExpr(
            f"'{name}' as route", f"cast({mid} as string) as mid", f"cast({ts} as bigint) as ts",
            f"cast({detail} as string) as detail") for name, (mid, ts, detail) in what.items()])


def _changes(spark, recs: DataFrame, root: str, config, cuts=CUTS, between=None):
    """Replay change records through the change job; (dimension table, fact folder)."""
    src = f"{root}/src"
    sink = DayTable(spark, f"{root}/dims", ["table", "id"], ["table"], seq="seq")

    def run_once():
        query = jobs.cdc_stream(file_stream(spark, src, recs.schema), config, f"{root}/facts",
                                sink, f"{root}/ckpt", trigger=AVAILABLE_NOW,
                                state_partitions=_state_partitions(spark))
        if between:
            query.awaitTermination()
            between()
        return query
    replay([[(src, c)] for c in time_chunks(recs, "seq", cuts)], run_once)
    return sink, f"{root}/facts"


def stream_cdc_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + K2 + K3: change records replayed in three steps; the dimension
    snapshot (latest per key, deletes as hidden tombstones) is the result."""
    sink, _ = _changes(spark, adapters.cdc_records(spark, sf_dir), scratch_path(spark, "stream-cdc"),
                       lambda: adapters.table_config(spark))
    return jobs.dim_snapshot(sink).select("dim_key", "table", "id", "op", "seq")


def stream_fact_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the fact topics read back, each row with its place among its key's rows as
    they stand in the files of batch after batch."""
    _, facts = _changes(spark, adapters.cdc_records(spark, sf_dir),
                        scratch_path(spark, "stream-facts"), lambda: adapters.table_config(spark))
    rows = spark.read.schema(FACTS).parquet(facts).select(
        "topic", "key", "seq", digest_of_value(), "batch_id",
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    order = Window.partitionBy("topic", "key").orderBy("batch_id", "file", "place")
    return rows.select("topic", F.col("key"), "seq", "value",
                       F.row_number().over(order).cast("bigint").alias("turn"))


def stream_cdc_config_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routing table is edited between two batches; the second follows it."""
    root = scratch_path(spark, "stream-config")
    edits = [["order_info", "user_info"], ["order_info", "base_province"]]

    def edit():
        if edits:
            adapters.table_config(spark, fact=edits.pop(0)).write.mode("overwrite").parquet(f"{root}/config")
    edit()
    _, facts = _changes(spark, adapters.cdc_records(spark, sf_dir), root,
                        lambda: spark.read.parquet(f"{root}/config"), [0.5], edit)
    return spark.read.schema(FACTS).parquet(facts).groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))


def _dimension(sink: DayTable, name: str, schema: str) -> DataFrame:
    rows = jobs.dim_snapshot(sink).where(F.col("table") == name)
    return rows.select(F.from_json("data", schema).alias("r")).select("r.*")


def stream_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs one after another: change records as topic text fill the dimensions, raw
    logs are routed, and the daily-active job reads the page route and these dimensions."""
    root = scratch_path(spark, "stream-chain")
    users, provinces = adapters.user_info(spark, sf_dir), adapters.base_province(spark, sf_dir)
    text = reduce(DataFrame.unionByName, [
        d.select(F.to_json(F.struct(F.lit(name).alias("table"), F.lit("insert").alias("type"),
                                    F.to_json(F.struct(*d.columns)).alias("data"),
                                    F.col("id").cast("bigint").alias("seq"))).alias("value"))
        for name, d in (("user_info", users), ("base_province", provinces))])
    records = text.select(parse("value", CDC_RECORD).alias("r")).select("r.*")
    sink, _ = _changes(spark, records, f"{root}/changes",
                       lambda: adapters.table_config(spark, fact=[], dim=["user_info", "base_province"]))
    pages = f"{_routed(spark, sf_dir, f'{root}/logs')}/page"
    actives = DayTable(spark, f"{root}/dau", ["dt", "mid"], ["dt"])
    schema = spark.read.parquet(pages).drop("batch_id").schema
    jobs.dau_stream(
        file_stream(spark, pages, schema),
        lambda: _dimension(sink, "user_info", "id bigint, gender string, birthday date"),
        lambda: _dimension(sink, "base_province", "id int, name string, area_code string, "
                           "iso_code string, iso_3166_2 string"),
        actives, f"{root}/dau-ckpt", lambda: adapters.USER_AS_OF, trigger=AVAILABLE_NOW,
        state_partitions=_state_partitions(spark)).awaitTermination()
    return actives.read().select("dt", "mid", "brand", "user_gender", "user_age", "province_name")


def stream_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest day arrives first; of the older days that follow, those beyond the
    watermark are dropped, and counted."""
    root = scratch_path(spark, "stream-late")
    pl = written(adapters.page_log(spark, sf_dir), f"{root}/pages")
    day = F.floor(F.col("ts") / F.lit(86_400_000))
    newest = pl.agg(F.max(day)).first()[0] or 0
    sink = DayTable(spark, f"{root}/sink", ["dt", "mid"], ["dt"])
    users, provinces = _dims(spark, sf_dir)

    def run_once():
        return jobs.dau_stream(file_stream(spark, f"{root}/src", pl.schema), users, provinces, sink,
                               f"{root}/ckpt", adapters.USER_AS_OF, trigger=AVAILABLE_NOW,
                               state_partitions=_state_partitions(spark))
    with StageMetrics(spark, f"{root}/metrics") as metrics:
        replay([[(f"{root}/src", pl.where(day >= newest))], [(f"{root}/src", pl.where(day < newest))]], run_once)
        metrics.settle()
    late = metrics.read().where(F.col("stage") == LATE)
    return late.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("dropped"))
