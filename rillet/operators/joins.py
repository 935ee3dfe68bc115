"""Joins (J1-J3, J5, J6).

Broadcast policy: a side is broadcast only after its size is proven below a
bound (``bounded_broadcast``: one aggregate over LIMIT n+1 rows, which stops
early, gives the row count and a byte estimate). Dimensions
with no natural bound (users) get no hint: the planner uses a shuffle join and
AQE may still switch to a broadcast from the measured shuffle size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from rillet.functions.time import age_years

# Bounds for broadcast dimensions (provinces, config tables).
SMALL_DIM_ROWS = 100_000
SMALL_DIM_BYTES = 64 * 1024 * 1024


def _field_bytes(f) -> Column:
    """Byte estimate of one field: UTF-8/binary length for strings and bytes,
    the JSON length for nested values, 8 for fixed-width values."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(f.dataType, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return F.lit(8)


def bounded_broadcast(df: DataFrame, max_rows: int = SMALL_DIM_ROWS,
                      max_bytes: int = SMALL_DIM_BYTES) -> DataFrame:
    """Broadcast hint only when ``df`` has at most ``max_rows`` rows and about
    ``max_bytes`` bytes; otherwise the planner's shuffle join (and AQE) decide."""
    width = sum((_field_bytes(f) for f in df.schema.fields), F.lit(0))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(width.cast("bigint")).alias("b")).first()
    ok = r["n"] <= max_rows and (r["b"] or 0) <= max_bytes
    return F.broadcast(df) if ok else df


def enrich_user(df: DataFrame, users: DataFrame, as_of: str | Column,
                user_col: str = "user_id") -> DataFrame:
    """Left lookup join on the user dimension -> user_gender, user_age.

    A missing user keeps the row with null gender/age (the reference fails the
    task instead). ``as_of`` fixes the run date of the age formula.
    """
    as_of_c = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    u = users.select(F.col("id").alias("__uid"), F.col("gender").alias("user_gender"),
                     age_years("birthday", as_of_c).alias("user_age"))
    key = F.col(user_col).try_cast("bigint")  # an id that is no number has no user
    return df.join(u, key == F.col("__uid"), "left").drop("__uid")


def enrich_province(df: DataFrame, provinces: DataFrame, province_col: str = "province_id",
                    iso_3166_col: str = "province_iso_3166_2") -> DataFrame:
    """Left lookup join on the (bounded) province dimension."""
    p = bounded_broadcast(provinces.select(
        F.col("id").alias("__pid"), F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias(iso_3166_col)))
    return df.join(p, F.col(province_col).try_cast("int") == F.col("__pid"), "left").drop("__pid")


def order_full_outer(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Full outer equi join order.id = detail.order_id (same batch)."""
    o = orders.select([F.col(c).alias(f"o_{c}") for c in orders.columns])
    d = details.select([F.col(c).alias(f"d_{c}") for c in details.columns])
    return o.join(d, F.col("o_id") == F.col("d_order_id"), "full_outer")


WIDE_DETAIL = ["sku_id", "order_price", "sku_num", "sku_name", "split_total_amount",
               "split_activity_amount", "split_coupon_amount"]
WIDE_PLAIN = ["province_id", "order_status", "user_id", "total_amount",
              "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
              "feight_fee", "feight_fee_reduce", "operate_time", "expire_time",
              "refundable_time", "create_date", "create_hour"]
WIDE_ORDER = WIDE_PLAIN + ["province_name", "province_area_code", "province_iso_code",
                           "province_iso_3166_2", "user_gender", "user_age"]


def order_wide(orders: DataFrame, details: DataFrame, how: str = "inner",
               extra: Column | None = None, dimensions: bool = True) -> DataFrame:
    """Merge an order with each of its details into one wide row; ``dimensions``
    tells whether the orders carry their user and province columns already.

    Precedence follows the merge order (order copied first, detail second):
    create_time is the detail's, create_date/create_hour are the order's,
    detail_id = detail.id, order_id = order.id. ``extra`` may reference the
    aliases ``o`` and ``d``. Columns that neither side has yet are left out.
    """
    o = orders.alias("o")
    d = details.alias("d")
    cond = F.col("d.order_id") == F.col("o.id")
    if extra is not None:  # e.g. the event-time range of a stream-stream join
        cond = cond & extra
    j = d.join(o, cond, how)
    cols = [F.col("d.id").alias("detail_id"), F.col("o.id").alias("order_id")]
    cols += [F.col(f"d.{c}") for c in WIDE_DETAIL if c in details.columns]
    cols += [F.col("d.create_time").alias("create_time")]
    cols += [F.col(f"o.{c}") for c in (WIDE_ORDER if dimensions else WIDE_PLAIN) if c in orders.columns]
    return j.select(*cols)


def semi_by_config(df: DataFrame, config: DataFrame, role: str,
                   table_col: str = "table") -> DataFrame:
    """Keep change rows whose table is configured with ``role``."""
    names = bounded_broadcast(config.where(F.col("role") == role)
                              .select(F.col("table_name").alias("__t")).distinct())
    return df.join(names, F.col(table_col) == F.col("__t"), "left_semi")
