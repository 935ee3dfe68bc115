"""Deduplication, state repair and stage counters.

Skew: "first row per key" is an aggregation (min_by over an ordering struct), so
it gets a map-side partial aggregate and a hot key never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.functions.time import day_of, hour_of


def entry_pages(page_log: DataFrame) -> DataFrame:
    """session-entry pages only (no previous page)."""
    return page_log.where(F.col("last_page_id").isNull())


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per ``keys`` by ``order`` (ascending), as an aggregate."""
    payload = [c for c in df.columns if c not in keys]
    rec = F.struct(*[F.col(c) for c in payload])
    ordering = F.struct(*[F.col(c) for c in order])
    out = df.groupBy(*keys).agg(F.min_by(rec, ordering).alias("__r"))
    return out.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in payload]).select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the last row per ``keys`` by ``order`` (latest wins)."""
    payload = [c for c in df.columns if c not in keys]
    rec = F.struct(*[F.col(c) for c in payload])
    ordering = F.struct(*[F.col(c) for c in order])
    out = df.groupBy(*keys).agg(F.max_by(rec, ordering).alias("__r"))
    return out.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in payload]).select(*df.columns)


def with_day_hour(df: DataFrame, ts_col: str = "ts", tz: str = "UTC") -> DataFrame:
    """Add dt ('yyyy-MM-dd') and hr ('HH') from epoch ms."""
    return df.withColumn("dt", day_of(ts_col, tz)).withColumn("hr", hour_of(ts_col, tz))


def daily_active(page_log: DataFrame, tz: str = "UTC", order: tuple = ("ts", "seq")) -> DataFrame:
    """D1 (batch form): first entry page per (day, mid), ordered by ts then seq."""
    e = with_day_hour(entry_pages(page_log), "ts", tz)
    return first_per_key(e, ["dt", "mid"], list(order))


def rebuild_state(new_rows: DataFrame, sink: DataFrame, keys=("dt", "mid")) -> DataFrame:
    """D3: rows whose key is already in the sink are repeats (state rebuilt from the sink)."""
    return new_rows.join(sink.select(*keys).distinct(), list(keys), "left_anti")


def stage_counts(page_log: DataFrame, tz: str = "UTC") -> DataFrame:
    """Row counts after each stage of the daily-active pipeline
    (parse, entry filter in one pass; dedup from its aggregate)."""
    counts = page_log.agg(
        F.count(F.lit(1)).alias("parsed"),
        F.count_if(F.col("last_page_id").isNull()).alias("entry_filter"))
    stacked = counts.select(F.expr(
        "stack(2, 'parsed', parsed, 'entry_filter', entry_filter) as (stage, rows)"))
    dedup = daily_active(page_log, tz).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("dedup").alias("stage"), "rows")
    return stacked.unionByName(dedup)


def observe_stage(df: DataFrame, name: str) -> DataFrame:
    """D4 in streams: count rows of a stage without an extra job."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def event_rollup(df: DataFrame, key: str, event: str, ts: str, measure: str,
                 tie: str | None = None, chunk_ms: int = 3_600_000) -> DataFrame:
    """Roll consecutive rows of one event kind per key into one event
    (gaps-and-islands): start/last time and measure, min/max, row count. Null keys and
    null events are a key and an event like any other.

    One scan, no join. Rows are ordered only within a (key, time chunk), an hour by
    default, and shrink to that chunk's runs. Only a chunk's first and last run can
    continue in a neighbour; these edges, at most two per chunk, are ordered per key,
    while the runs between them stay in groups of their own chunk.
    """
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])
    at = F.struct(*order)
    chunk = F.floor(F.col(ts) / F.lit(chunk_ms)).cast("bigint")
    w_in = Window.partitionBy(key, "__chunk").orderBy(*order)
    x = df.withColumn("__chunk", chunk).withColumn("__at", at).withColumn(
        "__new", F.when(F.row_number().over(w_in) == 1, 0).otherwise(
            (~F.lag(event).over(w_in).eqNullSafe(F.col(event))).cast("int")))
    x = x.withColumn("__run", F.sum("__new").over(
        w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pieces = x.groupBy(key, "__chunk", "__run").agg(
        F.first(event).alias(event), F.min("__at").alias("__first"), F.max("__at").alias("__last"),
        F.min_by(measure, "__at").alias("start_value"), F.max_by(measure, "__at").alias("end_value"),
        F.min(measure).alias("min_value"), F.max(measure).alias("max_value"),
        F.count(F.lit(1)).alias("n_rows"))
    last_run = F.max("__run").over(Window.partitionBy(key, "__chunk"))
    edge = (F.col("__run") == 0) | (F.col("__run") == last_run)
    pieces = pieces.withColumn("__group", F.when(edge, F.lit(None)).otherwise(F.col("__chunk")))
    w_group = Window.partitionBy(key, "__group").orderBy("__chunk", "__run")
    joins = (F.col("__group").isNull() & (F.col("__run") == 0) & (F.row_number().over(w_group) > 1)
             & F.lag(event).over(w_group).eqNullSafe(F.col(event)))
    pieces = pieces.withColumn("__new", (~joins).cast("int")).withColumn(
        "__no", F.sum("__new").over(w_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return pieces.groupBy(key, "__group", "__no").agg(
        F.first(event).alias(event),
        F.min("__first").getField(ts).alias("start_time"), F.max("__last").getField(ts).alias("end_time"),
        F.min_by("start_value", "__first").alias("start_value"),
        F.max_by("end_value", "__last").alias("end_value"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.sum("n_rows").alias("n_rows")).drop("__group", "__no")
