"""Visit sessions (used by the dashboard's visit statistics, Q4/Q6).

A session starts at an entry page (no previous page) and runs to the next entry
page of the same device. Sessions never cross a day (entry pages restart each
day). Pages are ordered per (device, day, minute) chunk only and shrink to the
chunk's runs. Only a chunk's first and last run can belong to a session of a
neighbouring chunk; these edges, at most two per chunk, are ordered per device-day,
while the runs between them are whole sessions in groups of their own chunk. So
neither a hot device nor a hot device-day is sorted in one task, and the page log
is read once.

Defined cases: a null device or day is one like any other; rows without a time come
before all others of their device-day; pages before a device-day's first entry page
are a session without an entry page; an empty log has no sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.operators.ordered import chunked_running_count


def sessionize(page_log: DataFrame, device: str = "mid", day: str = "dt",
               order: tuple = ("ts", "seq"), chunk_ms: int = 60_000) -> DataFrame:
    """Add ``session_no``: running count of entry pages per (device, day), in
    ``order`` (epoch-ms time first)."""
    chunk = F.floor(F.col(order[0]) / F.lit(chunk_ms)).cast("bigint")
    return chunked_running_count(page_log, [device, day], order,
                                 F.col("last_page_id").isNull(), "session_no", chunk)


def sessions(page_log: DataFrame, device: str = "mid", day: str = "dt",
             order: tuple = ("ts", "seq"), chunk_ms: int = 60_000) -> DataFrame:
    """One row per session: its first page's ``order`` columns, pages, duration (ms) and
    the first page's attributes."""
    group = [device, day]
    rows = page_log.select(
        *group, F.floor(F.col(order[0]) / F.lit(chunk_ms)).cast("bigint").alias("__chunk"),
        F.struct(*order).alias("__at"), F.col("last_page_id").isNull().cast("int").alias("__entry"),
        "during_time", F.struct("channel", "is_new").alias("__of"))
    so_far = (Window.partitionBy(*group, "__chunk").orderBy("__at")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = rows.withColumn("__run", F.sum("__entry").over(so_far)) \
        .groupBy(*group, "__chunk", "__run").agg(
            F.count(F.lit(1)).alias("pages"), F.sum("during_time").alias("duration_ms"),
            F.min("__at").alias("__at"), F.min_by("__of", "__at").alias("__of"))
    last = F.max("__run").over(Window.partitionBy(*group, "__chunk"))
    edge = (F.col("__run") == 0) | (F.col("__run") == last)
    # run 0 goes on with what came before its chunk; every other run starts a session
    runs = runs.withColumn("__own", F.when(~edge, F.struct("__chunk")))
    before = (Window.partitionBy(*group, "__own").orderBy("__chunk", "__run")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return runs.withColumn("__no", F.sum((F.col("__run") > 0).cast("int")).over(before)) \
        .groupBy(*group, "__own", "__no").agg(
            F.min("__at").alias("__first"), F.sum("pages").alias("pages"),
            F.sum("duration_ms").alias("duration_ms"), F.min_by("__of", "__at").alias("__of")) \
        .select(*group, "__first.*", "pages", "duration_ms", "__of.*")
