"""Cases at the edges of the operators: nulls, many buckets, string ids, ideographs, days
without rows, hot keys, changed dimensions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rillet.functions.text import fuzzy_any, highlight, match_any
from rillet.operators import aggregates, dedup, mutations, routing
from rillet.operators.ordered import chunked_previous, chunked_running_count
from rillet.operators.partitioner import route_partition, spread_partitions
from rillet.plans import dashboard, dau, publisher
from rillet.sources import adapters
from rillet.sources.day_table import DayTable
from rillet.streaming import jobs
from rillet.streaming.sources import cut_at, replay, time_chunks

from test_streaming import (D_SCHEMA, DAY1, O_SCHEMA, PAGE_SCHEMA, _details, _dims, _orders,
                            _pages)

SF = "/root/testdata/sf0.001"


def plan_of(frame):
    """The plan before any stage ran, with whole lists of filters."""
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 4000)
    return frame._jdf.queryExecution().executedPlan().toString().rpartition("== Initial Plan ==")[2]


def names(frame, condition):
    return sorted(r[0] for r in frame.where(condition).collect())


def test_stats_cover_every_age(spark):
    wide = spark.createDataFrame(
        [("red widget", str(age), "X" if age % 2 else "M", 1.0, "2024-01-01") for age in range(1, 121)]
        + [("red widget", None, None, 5.0, "2024-01-01")],
        "sku_name string, user_age string, user_gender string, split_total_amount double, create_date string")
    wide = wide.withColumn("user_age", F.col("user_age").cast("int")).withColumn(
        "split_total_amount", F.col("split_total_amount").cast("decimal(18,2)"))
    bands = {r.name: r.value for r in aggregates.stats_by_item(wide, "widget", None, "age").collect()}
    assert list(bands.values()) == [29, 21, 70]
    genders = {r.name: r.value for r in aggregates.stats_by_item(wide, "widget", None, "gender").collect()}
    assert genders == {"男": 60, "女": 60}  # a row per gender value
    rows = {r.type: r.rows for r in aggregates.stats_rows(wide, "widget", None, ["age", "region"]).collect()}
    assert rows == {"age": 3, "region": 0}


def test_fuzzy_takes_every_token_and_one_edit_per_exchange(spark):
    n = spark.createDataFrame([("Red widget",), ("rod gadget",), ("ed",), ("wdiget red",), ("",)], "name string")
    assert names(n, fuzzy_any("name", "rod gizmo", 2)) == []
    assert names(n, fuzzy_any("name", "red widget", 1)) == ["Red widget", "wdiget red"]
    assert names(n, fuzzy_any("name", "wdigte", 1)) == ["wdiget red"]
    assert names(n, fuzzy_any("name", "wdigte", 2)) == ["Red widget", "wdiget red"]
    assert names(n, fuzzy_any("name", "", 2)) == names(n, fuzzy_any("name", "?!", 2)) == []


def test_highlight_follows_the_tokenizer(spark):
    n = spark.createDataFrame([("天天行动",), ("小米手机 128G",), ("ÉCLAIR éclairs",), ("x手机y",)], "name string")
    def marked(query):
        return [r[0] for r in n.where(match_any("name", query)).select(highlight("name", query)).collect()]
    assert marked("行动") == ["天天<em>行</em><em>动</em>"]
    assert marked("手机") == ["小米<em>手</em><em>机</em> 128G", "x<em>手</em><em>机</em>y"]
    assert marked("éclair") == ["<em>ÉCLAIR</em> éclairs"]
    assert marked("128g y") == ["小米手机 <em>128G</em>", "x手机<em>y</em>"]


def test_change_records_keep_string_ids(spark):
    recs = spark.createDataFrame(
        [("user_info", "insert", json.dumps({"id": i, "status": "a"}), s)
         for s, i in enumerate(["u-1", "u-2", 7, "u-1"])], "table string, type string, data string, seq long")
    ops = routing.cdc_ops(recs)
    config = adapters.table_config(spark)
    dims = routing.dim_route(ops, config).collect()
    assert sorted((r.dim_key, r.seq) for r in dims) == [
        ("DIM:USER_INFO:7", 2), ("DIM:USER_INFO:u-1", 3), ("DIM:USER_INFO:u-2", 1)]
    assert {r.key for r in routing.fact_route(ops, config).collect()} == {"u-1", "u-2", "7"}


def test_rollup_keeps_null_keys_and_null_events(spark):
    hour = 3_600_000
    rows = [("k", "a", 1, 1.0), ("k", None, 2, 2.0), ("k", "a", 3, 3.0), (None, "a", 1, 4.0), (None, "a", hour, 5.0),
            (None, None, hour + 1, 6.0), (None, None, 3 * hour, 7.0), ("z", "b", 5, 8.0), ("z", "c", hour, 9.0),
            ("z", "b", hour + 1, 1.0), ("z", "b", hour + 2, 2.0), ("z", "c", hour + 3, 3.0), ("z", "c", 9 * hour, 4.0)]
    frame = spark.createDataFrame(rows, "key string, event string, ts long, v double")
    out = dedup.event_rollup(frame, "key", "event", "ts", "v")
    got = sorted(((r.key, r.event, r.start_time, r.end_time, r.start_value, r.end_value, r.n_rows)
                  for r in out.collect()), key=str)
    assert got == sorted([
        ("k", "a", 1, 1, 1.0, 1.0, 1), ("k", None, 2, 2, 2.0, 2.0, 1), ("k", "a", 3, 3, 3.0, 3.0, 1),
        (None, "a", 1, hour, 4.0, 5.0, 2), (None, None, hour + 1, 3 * hour, 6.0, 7.0, 2),
        ("z", "b", 5, 5, 8.0, 8.0, 1), ("z", "c", hour, hour, 9.0, 9.0, 1),
        ("z", "b", hour + 1, hour + 2, 1.0, 2.0, 2), ("z", "c", hour + 3, 9 * hour, 3.0, 4.0, 2)], key=str)
    plan = plan_of(out)
    assert plan.count("Scan ") == 1 and "Join" not in plan and plan.count("Exchange hash") == 2


def test_replays_keep_rows_without_a_time(spark):
    frame = spark.createDataFrame([(1, 10), (2, None), (3, 30), (4, 50)], "id int, ts long")
    chunks = [sorted(r.id for r in c.collect()) for c in time_chunks(frame, "ts", [0.33, 0.66])]
    assert chunks == [[1, 2], [3], [4]]
    assert [c.count() for c in cut_at(frame, "ts", [])] == [4]
    assert sum(c.count() for c in time_chunks(frame.where("ts is null"), "ts", [0.5])) == 1


def test_any_asked_day_has_24_hours(spark):
    dau_rows = spark.createDataFrame([("2024-01-01", "03", "m1"), ("2024-01-01", "03", "m2"), ("2024-01-02", "05", "m1")],
                                     "dt string, hr string, mid string")
    for day, td, yd in (("2024-01-02", {"05": 1}, {"03": 2}), ("2024-01-03", {}, {"05": 1}), ("2030-01-01", {}, {})):
        rows = aggregates.dau_hours(dau_rows, day).collect()
        assert len(rows) == 24 and {r.dt for r in rows} == {day}
        assert {r.hr: r.dau_td for r in rows if r.dau_td} == td
        assert {r.hr: r.dau_yd for r in rows if r.dau_yd} == yd
        assert {r.dau_total for r in rows} == {sum(td.values())}


def test_generated_ids_differ_with_their_content(spark):
    empty = spark.createDataFrame([], "id string, a string, b string")
    new = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("x", None), (None, "x"), ('q"', "")], "a string, b string")
    ids = [r.id for r in mutations.append_with_id(empty, new, "id", ["a", "b"]).collect()]
    assert len(set(ids)) == 5 and ids == [r.id for r in mutations.append_with_id(empty, new, "id", ["a", "b"]).collect()]
    same = spark.createDataFrame([("s", "s")] * 9, "a string, b string")
    assert mutations.append_with_id(empty, same, "id").select("id").distinct().count() == 9


def test_partition_ids_are_values_and_hot_keys_are_split(spark):
    frame = spark.range(4000).select(F.when(F.col("id") % 10 == 0, "nba").otherwise("cba").alias("k"), "id")
    routed = route_partition(frame, "k", {"cba": 0, "wnba": 1, "nba": 2})
    assert {(r.k, r.partition_id) for r in routed.select("k", "partition_id").distinct().collect()} == {("cba", 0), ("nba", 2)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = spread_partitions(routed, ["id"]).where("k = 'cba'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 3


def test_previous_row_by_chunks_equals_lag(spark):
    rows = [("hot" if k % 10 else f"g{k % 3}", k * 37 % 1000, k, None if k % 4 == 0 else f"v{k % 5}") for k in range(800)]
    rows += [(None, 5, 900, "n"), (None, 700, 901, "m")]
    frame = spark.createDataFrame(rows, "g string, ts long, id long, v string")
    frame.createOrReplaceTempView("prev_rows")
    want = spark.sql("select id, lag(v) over (partition by g order by ts, id) p from prev_rows").collect()
    got = chunked_previous(frame, ["g"], ["ts", "id"], "v", "p", F.floor(F.col("ts") / 100)).select("id", "p").collect()
    assert sorted(got, key=str) == sorted(want, key=str)
    n = chunked_running_count(frame, ["g"], ["ts", "id"], F.col("v").isNull(), "n", F.floor(F.col("ts") / 100))
    assert n.count() == len(rows)


@pytest.mark.parametrize("name", ["dau_wide", "log_page_route", "q04_new_visit_stats", "q07_page_path"])
def test_no_window_is_ordered_by_user_or_day_alone(spark, name):
    from rillet.plans.registry import QUERIES
    for line in plan_of(QUERIES[name](spark, SF)).splitlines():
        if "Window [lag(event_type" in line:  # (user, day, chunk), not (user, day)
            assert "__chunk" in line


def test_pages_need_no_customer_unless_asked(spark):
    for query in (dashboard.q01_pv, dashboard.q05_channel_pv, dashboard.q08_user_action_convert):
        assert "Join" not in plan_of(dashboard._pages(spark, SF)) and query(spark, SF).count() > 0
    assert "customer" in plan_of(adapters.page_log(spark, SF)) or "Join" in plan_of(adapters.page_log(spark, SF))


def test_days_bound_pages_and_orders(spark):
    rows = {r.step_no: r for r in dashboard.q08_user_action_convert(spark, SF, days=1).collect()}
    whole = {r.step_no: r for r in dashboard.q08_user_action_convert(spark, SF).collect()}
    assert 0 < rows[4].users < whole[4].users and rows[5].users <= rows[4].users
    total = dashboard.q10_user_total(spark, SF, days=1).first()
    assert total.order_user_total == rows[4].users
    assert "GreaterThanOrEqual(o_orderdate" in plan_of(dashboard.q15_order_total(spark, SF, days=7))


def test_day_reads_prune_the_stored_tables(spark):
    plan = plan_of(publisher.detail_by_item_day(spark, SF))
    assert "PartitionFilters: [isnotnull(create_month" in plan and "EqualTo(create_date," in plan
    point = plan_of(publisher.point_get(spark, SF))
    assert "EqualTo(detail_id,1001)" in point and "PartitionFilters: [isnotnull(create_month" in point
    assert "Join" not in plan and "Join" not in point
    assert "PartitionFilters: [isnotnull(dt" in plan_of(dau.dau_total_day(spark, SF))


def test_order_rows_take_the_dimensions_of_their_batch(spark, scratch):
    _, provinces = _dims(spark)
    calls, known = [], [(1, "M", dt.date(2000, 2, 29))]

    def users():
        calls.append(len(known))
        return spark.createDataFrame(known, "id long, gender string, birthday date")
    sink = DayTable(spark, f"{scratch}/sink", ["detail_id"], ["create_date"])
    dates = iter(["2020-03-01", "2021-03-01", "2021-03-01", "2021-03-01"])

    def run_once():
        query = jobs.order_join_stream(
            spark.readStream.schema(O_SCHEMA).parquet(f"{scratch}/o"), spark.readStream.schema(D_SCHEMA).parquet(f"{scratch}/d"),
            users, provinces, sink, f"{scratch}/ckpt", lambda: next(dates), trigger={"availableNow": True})
        query.awaitTermination()
        if len(known) == 1:
            known.append((2, "F", dt.date(1990, 1, 1)))  # before the second user's order comes
        return query
    second = _orders(spark, [2]).withColumn("user_id", F.lit(2).cast("bigint"))
    replay([[(f"{scratch}/o", _orders(spark, [1])), (f"{scratch}/d", _details(spark, [(101, 1), (102, 2)]))],
            [(f"{scratch}/o", second)]], run_once)
    rows = {r.detail_id: (r.user_gender, r.user_age) for r in sink.read().collect()}
    assert rows[101] == ("M", 20) and rows[102] == ("F", 31) and calls[0] == 1 and calls[-1] == 2


def test_a_hot_device_is_split_before_its_state(spark, scratch):
    users, provinces = _dims(spark)
    sink = DayTable(spark, f"{scratch}/sink", ["dt", "mid"], ["dt"])
    rows = [("hot" if k % 10 else f"m{k}", "1", DAY1 + k, k) for k in range(500)]
    _pages(spark, rows).write.parquet(f"{scratch}/src")
    query = jobs.dau_stream(spark.readStream.schema(PAGE_SCHEMA).parquet(f"{scratch}/src"), users, provinces, sink,
                            f"{scratch}/ckpt", "2001-03-01", trigger={"availableNow": True})
    query.awaitTermination()
    assert sink.read().count() == 51
    state = [p["stateOperators"] for p in query.recentProgress if p["numInputRows"]][0]
    assert len(state) == 2 and max(op["numRowsUpdated"] for op in state) <= 50 + jobs.DEDUP_SALTS
