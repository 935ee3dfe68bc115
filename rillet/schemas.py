"""Record layouts (StructTypes) of the ODS, DWD and wide tables."""

from pyspark.sql.types import (ArrayType, DecimalType, LongType, StringType, StructField,
                               StructType)


def _s(*names, t=StringType()):
    return [StructField(n, t) for n in names]


COMMON = StructType(_s("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc"))
PAGE = StructType([StructField("during_time", LongType())]
                  + _s("item", "item_type", "last_page_id", "page_id", "source_type"))
ACTION = StructType(_s("action_id", "item", "item_type") + [StructField("ts", LongType())])
DISPLAY = StructType(_s("display_type", "item", "item_type", "order", "pos_id"))
START = StructType(_s("entry") + [StructField("loading_time", LongType())]
                   + _s("open_ad_id")
                   + [StructField("open_ad_ms", LongType()), StructField("open_ad_skip_ms", LongType())])

# ODS raw log record. ``err`` is forwarded whole, so it is kept as raw JSON text.
RAW_LOG = StructType([
    StructField("common", COMMON),
    StructField("page", PAGE),
    StructField("actions", ArrayType(ACTION)),
    StructField("displays", ArrayType(DISPLAY)),
    StructField("start", START),
    StructField("err", StringType()),
    StructField("ts", LongType()),
])

# Device fields shared by the DWD log tables (the common block, renamed).
DEVICE_FIELDS = ["province_id", "brand", "channel", "is_new", "model", "mid",
                 "operate_system", "user_id", "version_code"]

PAGE_LOG_FIELDS = DEVICE_FIELDS + ["during_time", "page_item", "page_item_type",
                                   "last_page_id", "page_id", "sourceType", "ts"]

ACTION_LOG_FIELDS = ["mid", "user_id", "province_id", "channel", "is_new", "model",
                     "operate_system", "version_code", "page_id", "last_page_id",
                     "page_item", "page_item_type", "during_time", "action_id",
                     "action_item", "action_item_type", "action_ts", "ts"]

DISPLAY_LOG_FIELDS = ["mid", "user_id", "province_id", "channel", "is_new", "model",
                      "operate_system", "version_code", "page_id", "last_page_id",
                      "page_item", "page_item_type", "during_time", "displayType",
                      "display_item", "display_item_type", "order", "pos_id", "ts"]

START_LOG_FIELDS = ["mid", "user_id", "province_id", "channel", "is_new", "model",
                    "operate_system", "version_code", "entry", "loading_time",
                    "open_ad_id", "open_ad_ms", "open_ad_skip_ms", "ts"]

DAU_INFO_FIELDS = DEVICE_FIELDS + ["during_time", "page_item", "page_item_type", "page_id",
                                   "user_gender", "user_age", "province_name",
                                   "province_iso_code", "province_iso_3166_2",
                                   "province_area_code", "dt", "hr", "ts"]

ORDER_INFO_FIELDS = ["id", "province_id", "order_status", "user_id", "total_amount",
                     "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
                     "feight_fee", "feight_fee_reduce", "create_time", "operate_time",
                     "expire_time", "refundable_time"]

ORDER_DETAIL_FIELDS = ["id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
                       "create_time", "split_total_amount", "split_activity_amount",
                       "split_coupon_amount"]


def _money(*names):
    return [StructField(n, DecimalType(18, 2)) for n in names]


# Typed records of the order topics (P2); a member missing in the text is null.
ORDER_INFO = StructType(
    [StructField("id", LongType()), StructField("province_id", LongType())] + _s("order_status")
    + [StructField("user_id", LongType())] + _money(*ORDER_INFO_FIELDS[4:10])
    + _s(*ORDER_INFO_FIELDS[10:]))
ORDER_DETAIL = StructType(
    [StructField(n, LongType()) for n in ORDER_DETAIL_FIELDS[:3]] + _money("order_price")
    + [StructField("sku_num", LongType())] + _s("sku_name", "create_time")
    + _money(*ORDER_DETAIL_FIELDS[7:]))

# Numeric zero defaults of the order and detail records (X11).
ORDER_INFO_DEFAULTS = {n: 0.0 for n in ORDER_INFO_FIELDS[4:10]}
ORDER_DETAIL_DEFAULTS = {"order_price": 0.0, "sku_num": 0, "split_total_amount": 0.0,
                         "split_activity_amount": 0.0, "split_coupon_amount": 0.0}

# Change record as its topic holds it (P1): the row's members stay JSON text in ``data``.
CDC_RECORD = StructType([
    StructField("table", StringType()),
    StructField("type", StringType()),
    StructField("data", StringType()),
    StructField("seq", LongType()),
])
