"""Structured Streaming jobs.

Each job is ``readStream -> the same DataFrame operators as batch -> writeStream``.
Micro-batch outputs go through ``foreachBatch`` into idempotent sinks, so a batch
replayed after a failure (offsets are committed after the sink write) rewrites
the same content: at-least-once delivery + idempotent sink = effectively once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillet.functions.misc import with_defaults
from rillet.operators import dedup, routing
from rillet.plans.dau import dau_info
from rillet.plans.orders import WIDE_COLUMNS, with_dates, with_dimensions
from rillet.schemas import ORDER_DETAIL_DEFAULTS, ORDER_INFO_DEFAULTS
from rillet.operators.joins import order_wide
from rillet.session import CLEANUP, conf_set
from rillet.streaming.state import rocksdb_state
from rillet.sources.day_table import DayTable, append_batch, write_keyed

DimFn = Callable[[], DataFrame]
#: A run date, or what gives it for each batch (a job that runs for days ages with it).
AsOf = str | Callable[[], str]

#: Parts into which a device's rows are split before its duplicates meet; as many as tasks
#: should share the hottest device.
DEDUP_SALTS = 8


#: Settings of a job whose state is large: states that a checkpoint keeps, how often older ones go.
LEAN = {"spark.sql.streaming.minBatchesToRetain": "2", CLEANUP: "true",
        "spark.sql.streaming.stateStore.maintenanceInterval": "15s"}


def _today(as_of: AsOf) -> str:
    return as_of() if callable(as_of) else as_of

LOG_ROUTES = {
    "error": routing.error_route,
    "page": routing.page_route,
    "action": routing.action_route,
    "display": routing.display_route,
    "start": routing.start_route,
}


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch in a keyed sink: batch ids count per checkpoint."""
    return f"{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}-{batch_id:09d}"


def _start(df: DataFrame, fn, checkpoint: str, trigger: dict, name: str | None = None,
           output_mode: str = "append", state_partitions: int | None = None,
           conf: dict[str, str] | None = None) -> StreamingQuery:
    """Start a foreachBatch query, with settings ``conf`` of its own. ``state_partitions`` fixes the number of
    state-store partitions, which RocksDB keeps on disk; it is recorded in the checkpoint at the first start
    and cannot change later, so it is chosen explicitly rather than inherited."""
    w = (df.writeStream.foreachBatch(fn).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(**trigger))
    if name:
        w = w.queryName(name)
    with conf_set(df.sparkSession, conf or {}), rocksdb_state(df.sparkSession, state_partitions):
        return w.start()  # the query clones the session conf here


def log_router(raw: DataFrame, out_root: str, checkpoint: str,
               trigger: dict | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """W2 + P1-P8 + K1: one parsed micro-batch feeds every route table."""
    def run(batch: DataFrame, batch_id: int):
        parsed = routing.parse_log(batch).persist()
        for name, route in LOG_ROUTES.items():
            append_batch(route(parsed), f"{out_root}/{name}", batch_id)
        append_batch(routing.quarantine(parsed).select("value"), f"{out_root}/quarantine",
                     batch_id)
        parsed.unpersist()
    return _start(raw, run, checkpoint, trigger or {"processingTime": "5 seconds"},
                  state_partitions=state_partitions)


def dau_stream(page_log: DataFrame, users: DimFn, provinces: DimFn, sink: DayTable,
               checkpoint: str, as_of: AsOf, late_days: int = 1, tz: str = "UTC",
               trigger: dict | None = None, rebuild_from_sink: bool = False,
               state_partitions: int | None = None, salts: int = DEDUP_SALTS) -> StreamingQuery:
    """W3 + D1 + D2 + W6: entry filter before the stateful dedup, then the
    (day, mid) dedup with an event-time watermark on the day (state for a day is
    dropped ``late_days`` days + 1 s after newer days arrive), then per-batch
    enrichment with freshly read dimensions and an upsert keyed by (dt, mid).

    ``rebuild_from_sink`` (D3): after a state loss, rows whose (dt, mid) is
    already in the sink are repeats; only the batch's days of the sink are read.
    """
    # Per-stage row counts land in each batch's progress (observedMetrics)
    parsed = dedup.observe_stage(page_log, "parsed")
    entry = dedup.observe_stage(dedup.entry_pages(parsed), "entry_filter")
    e = dedup.with_day_hour(entry, "ts", tz) \
        .withColumn("day_ts", F.to_timestamp("dt", "yyyy-MM-dd"))
    delay = f"{late_days * 24 * 3600 + 1} seconds"
    # two steps: a device's rows meet in parts first, so a device with a third of all rows
    # sends at most ``salts`` rows of a day to the task that holds its state
    salted = e.withColumn("salt", F.pmod(F.xxhash64("ts", "page_id"), F.lit(salts)))
    parts = salted.withWatermark("day_ts", delay).dropDuplicates(["day_ts", "mid", "salt"])
    d = dedup.observe_stage(parts.drop("salt").dropDuplicates(["day_ts", "mid"]), "dedup")

    def run(batch: DataFrame, batch_id: int):
        # the stateful part runs once: whatever asks for the batch, or for its rows with the
        # dimensions (the write samples them first), reads it persisted
        b = batch.drop("day_ts")
        seen = sink.touched_rows(b.persist()) if rebuild_from_sink else None
        new = b if seen is None else dedup.rebuild_state(b, seen.select("dt", "mid"))
        info = dau_info(new, users(), provinces(), _today(as_of)).persist()
        sink.upsert(info, batch_name(checkpoint, batch_id))
        info.unpersist()
        b.unpersist()
    return _start(d, run, checkpoint, trigger or {"processingTime": "5 seconds"},
                  state_partitions=state_partitions)


def order_join_stream(orders: DataFrame, details: DataFrame, users: DimFn, provinces: DimFn,
                      sink: DayTable, checkpoint: str, as_of: AsOf, delay: str = "1 day",
                      trigger: dict | None = None,
                      state_partitions: int | None = None) -> StreamingQuery:
    """W4 + W5 + J4: two streams, inner stream-stream join on order id with
    watermarks on both sides and an event-time range, so either arrival order
    pairs up and unmatched rows age out of state. Wide rows take the dimensions as they
    are when their batch runs, and upsert by detail_id into create_date partitions."""
    # defaults come after the join: state keeps the records as they arrived
    o = with_dates(orders) \
        .withColumn("__et", F.try_to_timestamp("create_time")).withWatermark("__et", delay)
    d = details \
        .withColumn("__et", F.try_to_timestamp("create_time")).withWatermark("__et", delay)
    window = F.col("d.__et").between(F.col("o.__et") - F.expr(f"INTERVAL {delay}"),
                                     F.col("o.__et") + F.expr(f"INTERVAL {delay}"))
    wide = order_wide(o, d, "inner", window, dimensions=False)

    def run(batch: DataFrame, batch_id: int):
        rows = with_defaults(batch, ORDER_INFO_DEFAULTS | ORDER_DETAIL_DEFAULTS)
        rows = with_dimensions(rows, users(), provinces(), _today(as_of)).select(*WIDE_COLUMNS)
        rows.persist()  # the write samples them first
        sink.upsert(rows, batch_name(checkpoint, batch_id))
        rows.unpersist()
    # a restart needs the last state alone, and a batch's rows are most of a state: older ones go
    return _start(wide, run, checkpoint, trigger or {"processingTime": "5 seconds"},
                  state_partitions=state_partitions, conf=LEAN)


def cdc_stream(records: DataFrame, config: DimFn, fact_path: str, dim_sink: DayTable,
               checkpoint: str, trigger: dict | None = None,
               state_partitions: int | None = None) -> StreamingQuery:
    """W7 + P9-P11 + K2 + K3: the routing config is re-read in every batch; fact
    rows go to keyed topic folders; dimension rows upsert (latest by seq) into a
    snapshot keyed by (table, id). A delete is stored as a tombstone row
    (op = 'D'); ``dim_snapshot`` hides it."""
    def run(batch: DataFrame, batch_id: int):
        cfg = config()
        ops = routing.cdc_ops(batch).persist()
        write_keyed(routing.fact_route(ops, cfg), fact_path, batch_id)
        dims = routing.dim_route(ops, cfg, compat=True).drop("rec")
        dim_sink.upsert(dims, batch_name(checkpoint, batch_id))
        ops.unpersist()
    return _start(records, run, checkpoint, trigger or {"processingTime": "5 seconds"},
                  state_partitions=state_partitions)


def dim_snapshot(dim_sink: DayTable, compat: bool = False) -> DataFrame:
    """Current dimension rows; tombstoned keys are hidden unless ``compat``."""
    df = dim_sink.read()
    return df if compat else df.where(F.col("op") != "D")
