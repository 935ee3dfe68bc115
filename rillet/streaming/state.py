"""Keyed state with timers (D2, D6): expiry at local midnight of the job's clock, and the
event roll-up over a stream. State is kept by the RocksDB provider, on executors' disks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rillet.session import conf_set

#: Groups of keys that share a state, and rows that go to it in one call.
BUCKETS, PART = 512, 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in RocksDB, in ``partitions`` parts."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    with conf_set(spark, wanted):
        yield


def next_midnight(millis: int, tz: str) -> int:
    """Epoch ms of the next local midnight after ``millis``."""
    zone = ZoneInfo(tz)
    day = (_EPOCH + dt.timedelta(milliseconds=millis)).astimezone(zone).date() + dt.timedelta(days=1)
    at = dt.datetime(day.year, day.month, day.day, tzinfo=zone)
    return int((at - _EPOCH) / dt.timedelta(milliseconds=1))


def in_buckets(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with the group of keys whose state ``key`` shares."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)))


def put_list(state, rows: list) -> None:
    """``rows`` as the whole of a list state."""
    state.clear()
    for start in range(0, len(rows), PART):
        state.appendList(rows[start:start + PART])


class MidnightExpiry(StatefulProcessor):
    """First row of a device since the last local midnight of the clock. The state of a
    bucket of devices lists, per device, the midnight until which it counts as seen; a timer
    removes it there. A row that comes after that midnight counts again even if the timer
    has not fired yet. A call to the state costs far more than a row of it: there are a few
    a bucket and batch, however many devices and days the bucket has."""

    def __init__(self, tz: str):
        self.tz = tz

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getListState("until", "mid string, until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        firsts: dict[str, dict[int, int]] = {}  # device -> next midnight -> first time
        for row in rows:
            if row.mid is not None:  # no device: such a row only moves the clock on
                until, days = next_midnight(row.seen, self.tz), firsts.setdefault(row.mid, {})
                days[until] = min(row.seen, days.get(until, row.seen))
        if not firsts:
            return
        known = dict(tuple(r) for r in self.until.get())
        timers = set()
        for mid, days in firsts.items():
            for until in sorted(days):
                if until > known.get(mid, until - 1):
                    known[mid] = until
                    timers.add(until)
                    yield Row(mid=mid, seen=days[until])
        if timers:
            put_list(self.until, list(known.items()))
            for until in timers & set(known.values()):
                self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = expiredTimerInfo.getExpiryTimeInMs()
        known = [tuple(r) for r in self.until.get()]
        left = [r for r in known if r[1] > passed]
        if len(left) < len(known):
            put_list(self.until, left)
        return iter(())

    def close(self) -> None:
        pass


def midnight_active_stream(page_log: DataFrame, clock: Column | None = None, tz: str = "UTC") -> DataFrame:
    """D1 + D2: ``(mid, seen)``, the first entry page of each device since local midnight of
    the job's clock (``clock``: epoch ms of the row's arrival; now, if none is given)."""
    clock = F.unix_millis(F.current_timestamp()) if clock is None else clock
    seen = (page_log.where(F.col("last_page_id").isNull()).select("mid", clock.alias("seen"))
            .withColumn("at", F.timestamp_millis("seen")).withWatermark("at", "0 seconds"))
    return in_buckets(seen, "mid").groupBy("bucket").transformWithState(
        MidnightExpiry(tz), "mid string, seen bigint", "Append", "EventTime")


# ---- roll-up ----------------------------------------------------------------------------
RUN = ("event string, start_time bigint, start_tie bigint, end_time bigint, end_tie bigint, "
       "start_value double, end_value double, min_value double, max_value double, n_rows bigint")
_RUN_FIELDS = [f.split()[0] for f in RUN.split(", ")]


def _least(values, choose):
    there = [v for v in values if v is not None]
    return choose(there) if there else None


def _in_order(row: tuple) -> tuple:
    """Time, then tie, rows without a tie first."""
    return row[1], row[2] is not None, row[2] or 0


class Rollup(StatefulProcessor):
    """Rows wait until the watermark has passed them, so that late ones take their place by
    time; then they are folded, in order, into their key's open run. A row of another kind
    closes it. Each run that grew is put out, with whether it is closed. The state is that of
    a bucket of keys: a call to it costs far more than a row of it, and there are a few a
    bucket and batch, however many keys and rows the bucket has."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "k string, ts bigint, tie bigint, event string, value double")
        self.open = handle.getListState("open", f"k string, {RUN}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, part = None, []
        for row in rows:
            part.append((row.k, row.ts, row.tie, row.event, row.value))
            first = row.ts if first is None else min(first, row.ts)
            if len(part) == PART:
                self.waiting.appendList(part)
                part = []
        if part:
            self.waiting.appendList(part)
        if first is not None:
            self.handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        ready, later = [], []
        for r in self.waiting.get():
            (ready if r[1] <= passed else later).append(tuple(r))
        if not ready:
            return
        ready.sort(key=_in_order)
        put_list(self.waiting, later)
        if later:
            self.handle.registerTimer(min(r[1] for r in later))
        runs = {r[0]: list(r[1:]) for r in self.open.get()}
        grown = set()
        for k, ts, tie, event, value in ready:
            run = runs.get(k)
            if run is not None and run[0] != event:
                yield Row(k=k, **dict(zip(_RUN_FIELDS, run)), closed=True)
                run = None
            if run is None:
                run = runs[k] = [event, ts, tie, ts, tie, value, value, value, value, 0]
            run[3:5], run[6] = [ts, tie], value
            run[7] = _least((run[7], value), min)
            run[8] = _least((run[8], value), max)
            run[9] += 1
            grown.add(k)
        put_list(self.open, [(k, *run) for k, run in runs.items()])
        for k in grown:
            yield Row(k=k, **dict(zip(_RUN_FIELDS, runs[k])), closed=False)

    def close(self) -> None:
        pass


def rollup_stream(rows: DataFrame, key: str, event: str, ts: str, measure: str, tie: str,
                  delay: str = "1 hour") -> DataFrame:
    """D6 over a stream: runs of one event kind per key. A run is put out whenever it grew;
    (k, start_time, start_tie) names it and the largest ``n_rows`` is its last form. Rows up
    to ``delay`` late take their place; the state holds those rows and one run a key, in
    ``BUCKETS`` groups of keys. Rows without a time have no place and are left out."""
    narrow = rows.select(
        F.to_json(F.struct(F.col(key).alias("key"))).alias("k"), F.col(ts).cast("bigint").alias("ts"),
        F.col(tie).cast("bigint").alias("tie"), F.col(event).alias("event"),
        F.col(measure).cast("double").alias("value"))
    late = (narrow.where(F.col("ts").isNotNull()).withColumn("at", F.timestamp_millis("ts"))
            .withWatermark("at", delay))
    return in_buckets(late, "k").groupBy("bucket").transformWithState(
        Rollup(), f"k string, {RUN}, closed boolean", "Update", "EventTime")


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          trigger: dict, mode: str = "append", partitions: int | None = None) -> StreamingQuery:
    """Start a stateful stream whose batches ``write`` takes."""
    with rocksdb_state(stream.sparkSession, partitions):
        return (stream.writeStream.foreachBatch(write).outputMode(mode)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())
