"""Log and change-record routing plans over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.json import member
from rillet.operators import routing
from rillet.sources import adapters


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.parse_log(adapters.raw_log_json(spark, sf_dir))


def log_route_counts(spark, sf_dir):
    return routing.route_counts(parsed_log(spark, sf_dir))


def log_error_route(spark, sf_dir):
    return routing.error_route(parsed_log(spark, sf_dir))


def log_page_route(spark, sf_dir):
    return routing.page_route(parsed_log(spark, sf_dir))


def log_action_explode(spark, sf_dir):
    return routing.action_route(parsed_log(spark, sf_dir))


def log_display_explode(spark, sf_dir):
    return routing.display_route(parsed_log(spark, sf_dir))


def log_display_compat(spark, sf_dir):
    return routing.display_route(parsed_log(spark, sf_dir), compat=True)


def log_start_route(spark, sf_dir):
    return routing.start_route(parsed_log(spark, sf_dir))


def _ops(spark, sf_dir):
    return routing.cdc_ops(adapters.cdc_records(spark, sf_dir))


def cdc_op_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ops(spark, sf_dir).select("seq", "table", "type", "op",
                                      F.col("rec.id").alias("id"))


def digest_of_value() -> F.Column:
    """Members of a fact row's ``value`` that the oracle compares: id and status."""
    return F.concat_ws("/", member("value", "$.id"), member("value", "$.status")).alias("value")


def cdc_fact_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = routing.fact_route(_ops(spark, sf_dir), adapters.table_config(spark))
    return r.select("topic", "key", "seq", digest_of_value())


def cdc_dim_latest(spark: SparkSession, sf_dir: str, compat: bool = False) -> DataFrame:
    r = routing.dim_route(_ops(spark, sf_dir), adapters.table_config(spark), compat)
    return r.select("dim_key", "table", "id", "op", "seq",
                    F.col("rec.status").alias("status"),
                    F.round(F.col("rec.amount"), 2).alias("amount"))
