"""URL filters by a temporal list join, in DataFrame functions alone.

List entries are dated events: an entry (list, kind, value) is added on a day and may be
removed and added again. Per entry the events become validity intervals [added, removed).
A capture is evaluated against the entries that were active when it was fetched: its url
gives candidate keys (every suffix of the host's labels for ``domain`` entries, the host
for ``host`` entries, the host with every directory of the path for ``prefix`` entries),
and an as-of join on the key and a time bucket finds the intervals that hold the fetch
day. A capture is blocked if a blocking list has an active entry for it and no allowing
list has.

Scale: captures are first reduced to distinct (host, path, day), so a hot host is judged
once for each of its pages and days; intervals are cut at buckets of ``BUCKET_DAYS``, so
a key's long history never meets a capture as a whole; both sides meet in one equi-join
that AQE can split. Nothing is broadcast by hint and no list goes through the driver.

Defined cases: of several events of an entry on a day the last by ``seq`` counts, a
removal before any addition does nothing; null lists, values and dates in entries are
ignored; a null url or one without a host, and a null day, match nothing and are not
blocked; repeated captures each give a row; empty tables give empty results or verdicts
without matches; other columns of captures are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 64
KINDS = ("domain", "host", "prefix")
_URL = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?"


def host_of(url: Column) -> Column:
    """Host in lower case without user, port and final dot; '' if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)), F.lit("."))


def path_of(url: Column) -> Column:
    """Path without query and fragment, '/' at least."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)
    return F.when(path == "", F.lit("/")).otherwise(path)


def _day(when: Column) -> Column:
    return F.datediff(when.cast("date"), F.lit("1970-01-01").cast("date"))


def _bucket(day: Column) -> Column:
    return F.floor(day / BUCKET_DAYS).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, kind, value, first, last)`` from ``entries(list, kind, value, action,
    day, seq)``: days since 1970 from the first to before the last, null if still open."""
    good = entries.where("list is not null and kind is not null and value is not null "
                         "and day is not null and action in ('add', 'remove')")
    # an entry has one event a day at most from here on
    daily = good.groupBy("list", "kind", "value", _day(F.col("day")).alias("first")).agg(
        F.max_by("action", F.struct("seq", "action")).alias("action"))
    order = Window.partitionBy("list", "kind", "value").orderBy("first")
    # consecutive additions are one interval
    turns = daily.withColumn("before", F.lag("action").over(order)).where(
        "not (action <=> before)").withColumn("last", F.lead("first").over(order))
    return turns.where("action = 'add'").select("list", "kind", "value", "first", "last")


def keys_of(host: Column, path: Column) -> Column:
    """Array of (kind, value) keys that could match a url."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(
        F.slice(labels, k, F.size(labels)), "."))
    parts = F.split(path, "/")  # the first part is empty
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.concat(
        host, F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))
    key = lambda kind: lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    return F.concat(F.transform(F.array_distinct(suffixes), key("domain")),
                    F.array(key("host")(host)), F.transform(F.array_distinct(folders), key("prefix")))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched",
          blocking: tuple[str, ...] = ("spam", "adult", "legal"),
          allowing: tuple[str, ...] = ("allow",)) -> DataFrame:
    """``captures`` with ``host``, ``n_active`` (active entries of any list), ``lists``
    (their lists, ordered), ``rule`` (the longest active blocking entry) and ``blocked``."""
    row = captures.select(F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias("row"),
                          host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                          _day(F.col(fetched)).alias("day"))
    asked = row.where("host <> '' and day is not null").select("host", "path", "day").distinct()
    wanted = asked.withColumn("key", F.explode(keys_of(F.col("host"), F.col("path")))).select(
        "host", "path", "day", "key.kind", "key.value", _bucket(F.col("day")).alias("bucket"))
    until = F.lit(captures.agg(F.max(_day(F.col(fetched)))).first()[0]).cast("int")
    spans = intervals(entries).where(F.col("kind").isin(*KINDS) & (F.col("first") <= until)).withColumn(
        "stop", F.least(F.coalesce(F.col("last") - 1, until), until))
    cut = spans.withColumn("bucket", F.explode(F.sequence(
        _bucket(F.col("first")), _bucket(F.col("stop")))))
    cut = cut.select("list", "kind", "value", "first", "stop", "bucket")
    active = wanted.join(cut, ["kind", "value", "bucket"]).where("day between first and stop")
    rule = F.concat_ws(":", "list", "kind", "value")
    blocks = F.col("list").isin(*blocking)
    verdicts = active.groupBy("host", "path", "day").agg(
        F.count(F.lit(1)).alias("n_active"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.max_by(F.when(blocks, rule), F.when(blocks, F.struct(F.length("value"), rule))).alias("rule"),
        (F.max(blocks) & ~F.max(F.col("list").isin(*allowing))).alias("blocked"))
    return row.join(verdicts, ["host", "path", "day"], "left").select(
        *(F.col("row")[c].alias(c) for c in captures.columns), "host",
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"), "rule",
        F.coalesce("blocked", F.lit(False)).alias("blocked"))
