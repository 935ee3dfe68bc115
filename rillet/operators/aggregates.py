"""Aggregations (A1-A11). All are groupBy/agg plans: Spark runs a map-side
partial aggregate before the shuffle, so hot keys are pre-combined."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.functions.text import match_all
from rillet.functions.time import previous_day

# Fixed labels of the dashboard results.
GENDER_MALE_LABEL = "男"
GENDER_OTHER_LABEL = "女"
AGE_BAND_LABELS = ("30岁以下", "30-50岁", "50岁以上")

HOURS = 24


def day_scope(df: DataFrame, date: str | None, col: str = "dt") -> DataFrame:
    """Restrict to one day partition; None = every day. An absent day is
    simply an empty result."""
    return df if date is None else df.where(F.col(col) == F.lit(date))


def day_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """A1: total rows of a day (exact count; 0 for a missing day)."""
    return day_scope(dau, date).agg(F.count(F.lit(1)).alias("dau_total"))


def count_by_hour(dau: DataFrame, date: str | None = None) -> DataFrame:
    """A2: rows per (dt, hr); only non-empty hours."""
    return day_scope(dau, date).groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))


def dau_hours(dau: DataFrame, date: str | None = None) -> DataFrame:
    """A3 + A4: per day, 24 hour rows with today's count, the previous calendar
    day's count (0 when absent) and today's total. An asked ``date`` always has its 24
    rows, also before its first row or after a day without any.

    One pass: the (dt, hr) counts (a days x 24 frame) are exploded into a
    "today" row, a "next day's yesterday" row and the 24 hour slots of the day,
    then summed per (dt, hr); no self-join of the input.
    """
    src = dau
    if date is not None:
        src = dau.where((F.col("dt") == F.lit(date)) | (F.col("dt") == previous_day(F.lit(date))))
    counts = src.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    nxt = F.date_format(F.date_add(F.to_date("dt"), 1), "yyyy-MM-dd")

    def slots(day):
        return F.transform(F.sequence(F.lit(0), F.lit(HOURS - 1)), lambda h: F.struct(
            day.alias("dt"), F.lpad(h.cast("string"), 2, "0").alias("hr"),
            zero.alias("td"), zero.alias("yd"), F.lit(1).alias("present")))
    own = F.array(F.struct(F.col("dt").alias("dt"), F.col("hr").alias("hr"), F.col("n").alias("td"),
                           zero.alias("yd"), F.lit(1).alias("present")),
                  F.struct(nxt.alias("dt"), F.col("hr").alias("hr"), zero.alias("td"),
                           F.col("n").alias("yd"), F.lit(0).alias("present")))
    rows = own if date is not None else F.concat(own, slots(F.col("dt")))
    ex = counts.select(F.explode(rows).alias("r")).select("r.*")
    if date is not None:
        asked = dau.sparkSession.range(1).select(F.explode(slots(F.lit(date))).alias("r"))
        ex = ex.where(F.col("dt") == F.lit(date)).withColumn("present", F.lit(1)) \
            .unionByName(asked.select("r.*"))
    per = (ex.groupBy("dt", "hr")
           .agg(F.sum("td").alias("dau_td"), F.sum("yd").alias("dau_yd"),
                F.max("present").alias("present"))
           .where(F.col("present") == 1))
    # day total over the small (days x 24) frame, without re-reading the input
    per = per.withColumn("dau_total", F.sum("dau_td").over(Window.partitionBy("dt")))
    return per.select(
        "dt", "hr", F.col("dau_td").cast("bigint").alias("dau_td"),
        F.col("dau_yd").cast("bigint").alias("dau_yd"),
        F.col("dau_total").cast("bigint").alias("dau_total"))


TYPE_TO_FIELD = {"gender": "user_gender", "age": "user_age"}


def stats_by_item(wide: DataFrame, item: str, date: str | None, type_: str) -> DataFrame:
    """Match the item keyword (all tokens) and sum split_total_amount over all
    rows: a labelled row per gender, or three age bands; rows without the field are left
    out, bands without a row are 0. An unknown type gives an empty result (A8)."""
    field = TYPE_TO_FIELD.get(type_)
    if field is None:
        return wide.where(F.lit(False)).select(
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("value"))
    scoped = day_scope(wide, date, "create_date").where(match_all("sku_name", item))
    scoped = scoped.where(F.col(field).isNotNull())
    if type_ == "gender":
        label = F.when(F.col(field) == "M", GENDER_MALE_LABEL).otherwise(GENDER_OTHER_LABEL)
        return scoped.groupBy(field).agg(
            F.sum("split_total_amount").cast("double").alias("value")).select(
            label.alias("name"), "value")
    age = F.col(field).cast("int")
    zero = F.lit(0).cast("decimal(38,2)")
    amount = F.col("split_total_amount")
    bands = scoped.agg(
        F.coalesce(F.sum(F.when(age < 30, amount)), zero).alias("b0"),
        F.coalesce(F.sum(F.when((age >= 30) & (age <= 50), amount)), zero).alias("b1"),
        F.coalesce(F.sum(F.when(age > 50, amount)), zero).alias("b2"))
    l0, l1, l2 = AGE_BAND_LABELS
    return bands.select(F.expr(
        f"stack(3, '{l0}', b0, '{l1}', b1, '{l2}', b2) as (name, value)")) \
        .select("name", F.col("value").cast("double").alias("value"))


def stats_rows(wide: DataFrame, item: str, date: str | None, types: list[str]) -> DataFrame:
    """How many rows each asked type's statistics have; 0 for an unknown type."""
    out = None
    for t in types:
        n = stats_by_item(wide, item, date, t).agg(F.count(F.lit(1)).alias("rows"))
        n = n.select(F.lit(t).alias("type"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


def max_agg(df: DataFrame, field: str, alias: str = "max_value") -> DataFrame:
    """Global max."""
    return df.agg(F.max(field).alias(alias))


def group_count_top(df: DataFrame, field: str, k: int = 10) -> DataFrame:
    """A10/L3: terms aggregation: count per key, count desc then key asc, top k."""
    return (df.where(F.col(field).isNotNull()).groupBy(field)
            .agg(F.count(F.lit(1)).alias("doc_count"))
            .orderBy(F.desc("doc_count"), F.asc(field)).limit(k))


def nested_avg_topk(docs: DataFrame, array_col: str, elem_field: str, measure: str,
                    k: int = 10, key_alias: str = "key") -> DataFrame:
    """Group by an element of a nested array (each document counted once per
    distinct element), average a parent measure, order by the average desc, top k."""
    names = F.array_distinct(F.transform(F.col(array_col), lambda x: x[elem_field]))
    ex = docs.select(F.explode(names).alias(key_alias), F.col(measure).alias("__m")) \
        .where(F.col(key_alias).isNotNull())
    return (ex.groupBy(key_alias)
            .agg(F.count(F.lit(1)).alias("doc_count"), F.avg("__m").alias("avg_measure"))
            .orderBy(F.desc("avg_measure"), F.asc(key_alias)).limit(k))
