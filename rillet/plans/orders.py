"""Order wide table: enrich orders, join them with their details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.json import parse, to_json_record
from rillet.functions.misc import with_defaults
from rillet.functions.time import split_datetime
from rillet.operators import joins
from rillet.schemas import ORDER_DETAIL_DEFAULTS, ORDER_INFO, ORDER_INFO_DEFAULTS
from rillet.session import stored_once
from rillet.sources import adapters


def with_dates(order_info: DataFrame) -> DataFrame:
    """create_date and create_hour."""
    d, h = split_datetime("create_time")
    return order_info.withColumn("create_date", d).withColumn("create_hour", h)


def dated_orders(order_info: DataFrame) -> DataFrame:
    """X11 defaults, X3 create_date/create_hour: what needs no other table."""
    return with_dates(with_defaults(order_info, ORDER_INFO_DEFAULTS))


def with_dimensions(rows: DataFrame, users: DataFrame, provinces: DataFrame, as_of) -> DataFrame:
    """J1 user, J2 province."""
    return joins.enrich_province(joins.enrich_user(rows, users, as_of), provinces)


def enrich_orders(order_info: DataFrame, users: DataFrame, provinces: DataFrame,
                  as_of: str) -> DataFrame:
    """Orders with defaults, day, hour and dimensions."""
    return with_dimensions(dated_orders(order_info), users, provinces, as_of)


def details(order_detail: DataFrame) -> DataFrame:
    """X11 defaults of the order lines."""
    there = {c: v for c, v in ORDER_DETAIL_DEFAULTS.items() if c in order_detail.columns}
    return with_defaults(order_detail, there)


def enriched_orders(spark: SparkSession, sf_dir: str,
                    as_of: str = adapters.USER_AS_OF) -> DataFrame:
    return enrich_orders(adapters.order_info(spark, sf_dir), adapters.user_info(spark, sf_dir),
                         adapters.base_province(spark, sf_dir), as_of)


def _wide_core(spark: SparkSession, sf_dir: str, as_of: str,
               part: adapters.Pass | None = None) -> DataFrame:
    """Wide rows without the province, of one pass if ``part`` is given: lines meet their order
    while they lie by order, and the part last, so that they are moved twice and not three times."""
    orders = joins.enrich_user(dated_orders(adapters.order_info(spark, sf_dir, part=part)),
                               adapters.user_info(spark, sf_dir), as_of)
    rows = joins.order_wide(orders, details(adapters.order_lines(spark, sf_dir, part=part)))
    return details(adapters.with_part(spark, sf_dir, rows))


def order_wide(spark: SparkSession, sf_dir: str, as_of: str = adapters.USER_AS_OF) -> DataFrame:
    """Wide rows: one per detail whose order exists (inner: the net effect of the
    reference's cross-batch join, which emits only matched pairs)."""
    return joins.enrich_province(_wide_core(spark, sf_dir, as_of),
                                 adapters.base_province(spark, sf_dir)).select(*WIDE_COLUMNS)


def stored_wide(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    """The wide table as the order job leaves it: written once per application and input,
    one folder per month of the order day, files ordered by day and id. A folder per day
    would hold a few kilobytes here. ``date`` prunes to its month's folder, and the day's
    filter, pushed to the scan, to the row groups of that day. Orders and their lines come in
    passes by order, and a pass's shuffle files go when it is written."""
    def write(path: str) -> None:
        for part in adapters.order_passes(spark, sf_dir):
            # the few provinces come last: their names are not moved with the rows
            rows = _wide_core(spark, sf_dir, adapters.USER_AS_OF, part).withColumn(
                "create_month", F.substring("create_date", 1, 7)).hint("rebalance", "create_month")
            wide = joins.enrich_province(rows, adapters.base_province(spark, sf_dir)).select(
                *WIDE_COLUMNS, "create_month").sortWithinPartitions("create_month", "create_date", "detail_id")
            wide.write.mode("append").option("compression", "zstd").partitionBy("create_month").parquet(path)
    path = stored_once(spark, "order-wide", sf_dir, write)
    wide = spark.read.schema(f"{WIDE_SCHEMA}, create_month string").parquet(path)
    if date is not None:
        wide = wide.where((F.col("create_month") == date[:7]) & (F.col("create_date") == date))
    return wide.drop("create_month")


def order_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same-batch full outer join; one row per matched pair or unmatched side."""
    j = joins.order_full_outer(adapters.order_info(spark, sf_dir),
                               adapters.order_detail(spark, sf_dir))
    return j.select(F.coalesce("o_id", "d_order_id").alias("order_id"),
                    F.col("d_id").alias("detail_id"),
                    F.col("o_id").isNotNull().alias("has_order"),
                    F.col("d_id").isNotNull().alias("has_detail"))


def order_docs(wide: DataFrame, parts: DataFrame) -> DataFrame:
    """Order documents with a nested item list array<struct<id, name>> (sorted),
    item name = the sku's brand. One group per order (bounded by its lines)."""
    w = wide.join(parts, "sku_id", "left")
    return (w.groupBy("order_id")
            .agg(F.first("total_amount").alias("total_amount"),
                 F.first("order_status").alias("order_status"),
                 F.array_sort(F.collect_list(F.struct(F.col("sku_id").alias("id"),
                                                      F.col("tm_name").alias("name"))))
                 .alias("items")))


WIDE_COLUMNS = ["detail_id", "order_id", *joins.WIDE_DETAIL, "create_time", *joins.WIDE_ORDER]
MONEY = {"order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount",
         *ORDER_INFO_DEFAULTS}
_LONG = {"detail_id", "order_id", "sku_id", "sku_num", "user_id"}
_INT = {"province_id", "user_age"}
WIDE_SCHEMA = ", ".join(
    f"{c} " + ("decimal(18,2)" if c in MONEY else "bigint" if c in _LONG else
               "int" if c in _INT else "string") for c in WIDE_COLUMNS)


def order_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide rows with money as double at the edge."""
    w = order_wide(spark, sf_dir)
    return w.select(*[F.col(c).cast("double").alias(c) if c in MONEY else F.col(c)
                      for c in WIDE_COLUMNS])


def order_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + X11: order records as topic text, some without amounts, read back typed with
    zero defaults."""
    o = adapters.order_info(spark, sf_dir)
    for name, n in (("total_amount", 5), ("original_total_amount", 3)):
        o = o.withColumn(name, F.when(F.col("id") % n != 0, F.col(name)))
    text = o.select(to_json_record().alias("value"))  # null members are left out
    typed = text.select(parse("value", ORDER_INFO).alias("r")).select("r.*")
    out = with_defaults(typed, ORDER_INFO_DEFAULTS)
    return out.select("id", "user_id", "create_time", *[
        F.col(c).cast("double").alias(c) for c in ORDER_INFO_DEFAULTS])
