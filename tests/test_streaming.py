"""Streaming = batch equivalence: rows delivered in 1, 2 or 3 files (restart per
file on one checkpoint), late rows, both arrival orders of the order join,
replayed delivery."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillet.sources.day_table import DayTable
from rillet.streaming import jobs
from rillet.streaming.sources import replay

DAY1, DAY2 = 86400000 * 19723, 86400000 * 19724  # 2024-01-01, 2024-01-02 UTC
PAGE_SCHEMA = ("province_id int, brand string, channel string, is_new string, model string, "
               "mid string, operate_system string, user_id string, version_code string, "
               "during_time long, page_item string, page_item_type string, last_page_id string, "
               "page_id string, sourceType string, ts long, seq long")


def _pages(spark, rows):
    return spark.createDataFrame(
        [(1, "b", "ch", "1", "m", mid, "ios", uid, "v", 10, "1", "sku_id", None, "home", "q", ts, s)
         for mid, uid, ts, s in rows], PAGE_SCHEMA)


def _dims(spark):
    users = spark.createDataFrame([(1, "M", dt.date(2000, 2, 29))],
                                  "id long, gender string, birthday date")
    prov = spark.createDataFrame([(1, "P1", "1", "1", "CN-01")],
                                 "id int, name string, area_code string, iso_code string, "
                                 "iso_3166_2 string")
    return (lambda: users), (lambda: prov)


def _run_dau(spark, root, batches, late_days=1):
    users, prov = _dims(spark)
    sink = DayTable(spark, f"{root}/sink", ["dt", "mid"], ["dt"])
    src = f"{root}/src"

    def run_once():
        s = spark.readStream.schema(PAGE_SCHEMA).parquet(src)
        return jobs.dau_stream(s, users, prov, sink, f"{root}/ckpt", "2001-03-01",
                               late_days=late_days, trigger={"availableNow": True})
    replay([[(src, _pages(spark, b))] for b in batches], run_once)
    return sink


ROWS = [("m1", "1", DAY1 + 10, 1), ("m1", "1", DAY1 + 20, 2), ("m1", "1", DAY2 + 5, 3),
        ("m2", "2", DAY1 + 30, 4)]
EXPECT = [("2024-01-01", "m1"), ("2024-01-01", "m2"), ("2024-01-02", "m1")]


@pytest.mark.parametrize("split", [[4], [2, 2], [1, 2, 1]])
def test_dau_dedup_any_split(spark, scratch, split):
    batches, i = [], 0
    for n in split:
        batches.append(ROWS[i:i + n])
        i += n
    sink = _run_dau(spark, scratch, batches)
    got = sorted((r["dt"], r["mid"]) for r in sink.read().collect())
    assert got == EXPECT
    row = sink.read().where("mid = 'm1' AND dt = '2024-01-01'").first()
    assert row["user_gender"] == "M" and row["user_age"] == 1 and row["province_name"] == "P1"
    m2 = sink.read().where("mid = 'm2'").first()
    assert m2["user_gender"] is None  # unknown user: kept, null dimension


@pytest.mark.parametrize("late_days,kept", [(1, True), (0, False)])
def test_dau_late_row(spark, scratch, late_days, kept):
    sink = _run_dau(spark, scratch, [[("m1", "1", DAY2 + 5, 1)], [("m9", "9", DAY1 + 5, 2)]],
                    late_days)
    mids = {r["mid"] for r in sink.read().collect()}
    assert ("m9" in mids) == kept


def test_dau_redelivery_is_idempotent(spark, scratch):
    sink = _run_dau(spark, scratch, [ROWS, ROWS])
    assert sink.read().count() == 3


def test_dau_stage_counts_observed(spark, scratch):
    users, prov = _dims(spark)
    sink = DayTable(spark, f"{scratch}/sink", ["dt", "mid"], ["dt"])
    src = f"{scratch}/src"
    _pages(spark, ROWS).write.parquet(src)
    q = jobs.dau_stream(spark.readStream.schema(PAGE_SCHEMA).parquet(src), users, prov, sink,
                        f"{scratch}/ckpt", "2001-03-01", trigger={"availableNow": True})
    q.awaitTermination()
    metrics = [p["observedMetrics"] for p in q.recentProgress if p["observedMetrics"]]
    assert metrics[0]["parsed"]["rows"] == 4 and metrics[0]["entry_filter"]["rows"] == 4
    assert metrics[0]["dedup"]["rows"] == 3


O_SCHEMA = ("id long, province_id int, order_status string, user_id long, "
            "total_amount decimal(18,2), activity_reduce_amount decimal(18,2), "
            "coupon_reduce_amount decimal(18,2), original_total_amount decimal(18,2), "
            "feight_fee decimal(18,2), feight_fee_reduce decimal(18,2), create_time string, "
            "operate_time string, expire_time string, refundable_time string")
D_SCHEMA = ("id long, order_id long, sku_id long, order_price decimal(18,2), sku_num long, "
            "sku_name string, create_time string, split_total_amount decimal(18,2), "
            "split_activity_amount decimal(18,2), split_coupon_amount decimal(18,2)")
T = "2024-01-01 10:00:00"


def _orders(spark, ids):
    return spark.createDataFrame([(i, 1, "O", 1, None, None, None, None, None, None, T,
                                   None, None, None) for i in ids], O_SCHEMA)


def _details(spark, pairs):
    return spark.createDataFrame([(d, o, 7, None, 1, "red widget", T, None, None, None)
                                  for d, o in pairs], D_SCHEMA)


def test_order_join_any_arrival_order(spark, scratch):
    users, prov = _dims(spark)
    sink = DayTable(spark, f"{scratch}/sink", ["detail_id"], ["create_date"])
    o_src, d_src = f"{scratch}/o", f"{scratch}/d"

    def run_once():
        o = spark.readStream.schema(O_SCHEMA).parquet(o_src)
        d = spark.readStream.schema(D_SCHEMA).parquet(d_src)
        return jobs.order_join_stream(o, d, users, prov, sink, f"{scratch}/ckpt", "2024-01-31",
                                      trigger={"availableNow": True})
    steps = [
        [(o_src, _orders(spark, [1])), (d_src, _details(spark, [(103, 3)]))],  # order 1 first
        [(d_src, _details(spark, [(101, 1), (102, 2)]))],                       # detail 2 first
        [(o_src, _orders(spark, [2, 4])), (d_src, _details(spark, [(104, 4)]))],  # same batch
    ]
    replay(steps, run_once)
    got = sorted((r["detail_id"], r["order_id"]) for r in sink.read().collect())
    assert got == [(101, 1), (102, 2), (104, 4)]  # detail 103 has no order: no row
    row = sink.read().where("detail_id = 101").first()
    assert row["create_date"] == "2024-01-01" and row["create_hour"] == "10"
    assert row["user_gender"] == "M" and row["province_name"] == "P1"
