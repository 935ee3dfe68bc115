"""Change and log records of any shape over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.operators import change_records, routing
from rillet.operators.change_records import read_member
from rillet.sources import adapters

#: What the jobs ask of members.
TYPES = {"order_info": {"$.total_amount": "double"}, "base_province": {"$.geo.area": "int"}}


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_records.parse_changes(adapters.shaped_changes(spark, sf_dir), TYPES)


def cdc_variant_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by topic and dimensions by key, each with members that only its table has."""
    parsed, config = _parsed(spark, sf_dir), adapters.table_config(spark)
    members = [read_member("$.total_amount", "double").alias("amount"),
               read_member("$.gender").alias("gender"), read_member("$.geo.area", "int").alias("area"),
               F.coalesce(F.size(read_member("$.lines", "array<variant>")), F.lit(0)).alias("lines")]
    facts = change_records.fact_rows(parsed, config).select("topic", "key", "seq", *members)
    dims = change_records.dim_rows(parsed, config)
    return facts.unionByName(dims.select(F.col("dim_key").alias("topic"), F.col("id").alias("key"), "seq", *members))


def cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_records.quarantine(_parsed(spark, sf_dir)).select("table", "seq", "fault")


def log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log records, some of them cut, without a time or with a duration that is no
    number: how many go to quarantine and why, and how many page rows are left."""
    raw = adapters.raw_log_json(spark, sf_dir)
    value = F.col("value")
    value = F.when(F.col("seq") % 10 == 0, F.regexp_replace(value, '"during_time":(-?[0-9]+)', '"during_time":"12x"')).otherwise(value)
    value = F.when(F.col("seq") % 19 == 0, F.regexp_replace(value, '"ts":([0-9]+)}$', '"at":$1}')).otherwise(value)
    value = F.when(F.col("seq") % 17 == 0, F.substring(value, 1, 20)).otherwise(value)
    parsed = routing.parse_log(raw.withColumn("value", value))
    bad = routing.quarantine(parsed).groupBy(F.col(routing.BAD).alias("fault")).agg(F.count(F.lit(1)).alias("rows"))
    pages = routing.page_route(parsed).agg(F.count(F.lit(1)).alias("rows"))
    return bad.unionByName(pages.select(F.lit("page").alias("fault"), "rows"))
