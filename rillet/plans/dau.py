"""Daily-active plans: page log -> entry filter -> dedup -> enrichment -> hour report."""

from __future__ import annotations

from datetime import date as _date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillet.functions.misc import copy_fields
from rillet.functions.time import day_of, hour_of
from rillet.operators import aggregates, dedup, joins
from rillet.schemas import DAU_INFO_FIELDS
from rillet.session import stored_once
from rillet.sources import adapters
from rillet.sources.day_table import DayTable


#: The newest day of an empty table.
NO_DAY = "1900-01-01"


def dau_rows(page_log: DataFrame, tz: str = "UTC") -> DataFrame:
    """F1 + D1 + X1/X2: one row per (dt, mid), the first entry page."""
    return dedup.daily_active(page_log, tz)


def dau_info(dau: DataFrame, users: DataFrame, provinces: DataFrame, as_of: str) -> DataFrame:
    """J1 + J2 + P12: DauInfo rows (same-named fields copied, dimensions joined)."""
    enriched = joins.enrich_province(joins.enrich_user(dau, users, as_of), provinces)
    return copy_fields(enriched, DAU_INFO_FIELDS)


def dau_wide(spark: SparkSession, sf_dir: str, tz: str = "UTC",
             as_of: str = adapters.USER_AS_OF) -> DataFrame:
    pl = adapters.page_log(spark, sf_dir)
    return dau_info(dau_rows(pl, tz), adapters.user_info(spark, sf_dir),
                    adapters.base_province(spark, sf_dir), as_of)


def dau_realtime_hours(spark: SparkSession, sf_dir: str, date: str | None = None,
                       tz: str = "UTC") -> DataFrame:
    """A1-A4 over the deduplicated daily actives: per day and hour, today's and
    the previous day's counts and today's total."""
    # the hour of a device's first entry page is the hour of its earliest entry
    # ts, so the dedup reduces to min(ts) per (dt, mid): a hash aggregate.
    # A given date needs that day and the one before: the scan reads those two.
    since = until = None
    if date is not None:
        d = _date.fromisoformat(date)
        since, until = (d - timedelta(days=1)).isoformat(), (d + timedelta(days=1)).isoformat()
    if tz != "UTC":
        since = until = None  # the day bounds are UTC days; other zones scan every day
    e = dedup.entry_pages(adapters.page_log(spark, sf_dir, since, until, province=False)).select("mid", "ts")
    e = e.withColumn("dt", day_of("ts", tz))
    first = e.groupBy("dt", "mid").agg(F.min("ts").alias("ts"))
    return aggregates.dau_hours(first.select("dt", hour_of("ts", tz).alias("hr"), "mid"), date)


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.stage_counts(adapters.page_log(spark, sf_dir, province=False))


def stored_dau(spark: SparkSession, sf_dir: str) -> DayTable:
    """The daily-active table as its job leaves it: keyed by (dt, mid), a folder per day;
    written once per application and input."""
    def table(path: str) -> DayTable:
        return DayTable(spark, path, ["dt", "mid"], ["dt"],
                        schema=StructType.fromDDL("dt string, mid string, hr string, ts bigint"))

    def write(path: str) -> None:
        pl = adapters.page_log(spark, sf_dir, province=False)
        table(path).upsert(dau_rows(pl).select("dt", "mid", "hr", "ts"))
        table(path).compact()
    return table(stored_once(spark, "dau", sf_dir, write))


def column_scan(spark: SparkSession, sf_dir: str, field: str = "mid") -> DataFrame:
    """Single-column scan of the stored daily-active table (every day, no row cap)."""
    return stored_dau(spark, sf_dir).read().select("dt", F.col(field))


def _newest(spark: SparkSession, sf_dir: str) -> str:
    from rillet.sources.tables import table
    day = table(spark, sf_dir, "events", "ts").agg(F.max(F.to_date("ts"))).first()[0]
    return NO_DAY if day is None else day.isoformat()


def dau_total_day(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    """A1 + S4: actives of one day, read from its partition."""
    day = date or _newest(spark, sf_dir)
    return aggregates.day_total(stored_dau(spark, sf_dir).read_partition(dt=day)).select(
        F.lit(day).alias("dt"), "dau_total")


def dau_count_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: actives per day and hour, hours without any left out."""
    return aggregates.count_by_hour(stored_dau(spark, sf_dir).read())


def dau_hours_empty_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 just after midnight: the day after the newest one has no row yet; its 24 hours
    stand against those of the day before."""
    tomorrow = _date.fromisoformat(_newest(spark, sf_dir)) + timedelta(days=1)
    return dau_realtime_hours(spark, sf_dir, tomorrow.isoformat())
