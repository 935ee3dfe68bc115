"""Rows that do not parse, and empty tables, in batch and stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillet.functions.json import member
from rillet.functions.time import split_datetime
from rillet.operators import change_records, joins, routing
from rillet.plans.registry import QUERIES
from rillet.sources.tables import TABLES
from rillet.streaming import jobs
from rillet.sources.day_table import DayTable
from tests.test_streaming import D_SCHEMA, DAY1, O_SCHEMA, T, _details, _dims, _orders, _pages


def test_ids_and_times_that_do_not_parse(spark):
    users = spark.createDataFrame([(1, "M", dt.date(2000, 2, 29))], "id long, gender string, birthday date")
    prov = spark.createDataFrame([(1, "P", "1", "1", "C")], "id int, name string, area_code string, iso_code string, iso_3166_2 string")
    rows = spark.createDataFrame([("1", "1"), ("u-7", ""), (None, "x"), ("", None), ("99999999999999999999", "9" * 12)],
                                 "user_id string, province_id string")
    out = joins.enrich_province(joins.enrich_user(rows, users, "2024-01-01"), prov).collect()
    assert len(out) == 5
    assert [r.user_gender for r in out if r.user_id == "1"] == ["M"]
    assert {r.user_gender for r in out if r.user_id != "1"} == {None} == {
        r.province_name for r in out if r.province_id != "1"}
    times = spark.createDataFrame([("2024-01-01 07:08:09",), ("2024-01-01",), ("",), (None,), ("a b",)], "t string")
    assert [tuple(r) for r in times.select(*split_datetime("t")).collect()] == [
        ("2024-01-01", "07"), ("2024-01-01", None), ("", None), (None, None), ("a", "b")]
    text = spark.createDataFrame([('{"a":"12x"}',), ('{"a":7}',), ("{",), (None,)], "v string")
    assert [r[0] for r in text.select(member("v", "$.a", "bigint")).collect()] == [None, 7, None, None]


def test_a_stream_survives_bad_rows(spark, scratch):
    users, prov = _dims(spark)
    sink = DayTable(spark, f"{scratch}/sink", ["detail_id"], ["create_date"])
    bad = _orders(spark, [1, 2]).withColumn("create_time", F.when(F.col("id") == 2, "bad").otherwise(T))
    bad.write.parquet(f"{scratch}/o")
    _details(spark, [(101, 1), (102, 2)]).write.parquet(f"{scratch}/d")
    query = jobs.order_join_stream(
        spark.readStream.schema(O_SCHEMA).parquet(f"{scratch}/o"), spark.readStream.schema(D_SCHEMA).parquet(f"{scratch}/d"),
        users, prov, sink, f"{scratch}/ckpt", "2024-01-31", trigger={"availableNow": True})
    query.awaitTermination()
    assert query.exception() is None
    assert [r.detail_id for r in sink.read().collect()] == [101]  # an order without a time meets none
    active = DayTable(spark, f"{scratch}/dau", ["dt", "mid"], ["dt"])
    _pages(spark, [("m1", "u-7", DAY1, 1), ("m2", "", DAY1, 2)]).write.parquet(f"{scratch}/p")
    query = jobs.dau_stream(spark.readStream.schema(_pages(spark, []).schema).parquet(f"{scratch}/p"), users, prov,
                            active, f"{scratch}/ckpt2", "2024-01-31", trigger={"availableNow": True})
    query.awaitTermination()
    assert query.exception() is None and active.read().count() == 2


def test_log_records_that_cannot_be_routed(spark):
    page = '"page":{"page_id":"home","during_time":%s}'
    rows = ['{"ts":1,' + page % 5 + "}", '{"ts":1,' + page % '"12x"' + "}", '{"ts":"a",' + page % 5 + "}",
            "{" + page % 5 + "}", "{", "", None, '{"ts":1,"actions":[{"ts":1},{"ts":"x"}],' + page % 5 + "}",
            '{"ts":1,' + page % "null" + "}", '{"ts":1,"start":{"open_ad_ms":1.5}}']
    parsed = routing.parse_log(spark.createDataFrame([(r,) for r in rows], "value string"))
    faults = [r[0] for r in parsed.select(routing.BAD).collect()]
    assert faults == [None, "no number: page.during_time", "no number: ts", "no ts", "no json", "no json", "no json",
                      "no number: actions.ts", None, "no number: start.open_ad_ms"]
    assert routing.page_route(parsed).count() == 2 and routing.quarantine(parsed).count() == 8


def test_change_records_of_any_shape(spark):
    rows = [("a", "insert", '{"id":1,"n":{"m":[1,2]}}', 1), ("a", "insert", '{"id":2,"n":"12x"}', 2),
            ("a", "update", '{"id":"3","n":12}', 3), ("b", "insert", '{"id":1,"n":"12x"}', 4), ("a", "insert", "{", 5),
            ("a", "insert", None, 6), ("a", "insert", '{"x":1}', 7), ("a", "other", "{", 8), ("c", "delete", "[1]", 9),
            ("a", "insert", '{"id":4,"n":null}', 10)]
    parsed = change_records.parse_changes(
        spark.createDataFrame(rows, "table string, type string, data string, seq bigint"), {"a": {"$.n": "int"}})
    faults = {r.seq: r.fault for r in parsed.collect()}
    assert faults == {1: "no int: $.n", 2: "no int: $.n", 3: None, 4: None, 5: "no json", 6: "no json", 7: "no id",
                      9: "no id", 10: None}
    assert change_records.quarantine(parsed).count() == 6


@pytest.fixture(scope="module")
def empty_tables(spark):
    from rillet.session import scratch_path
    root = scratch_path(spark, "empty")
    for name in TABLES:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.endswith("_7d")))
def test_every_query_takes_empty_tables(spark, empty_tables, name):
    QUERIES[name](spark, empty_tables).collect()


def test_stored_tables_follow_their_input(spark, scratch):
    from rillet.session import stored_once
    made = []

    def count():
        return stored_once(spark, "t", scratch, made.append)
    spark.range(3).write.parquet(f"{scratch}/a.parquet")
    first = count()
    assert count() == first and len(made) == 1
    spark.range(3).write.mode("append").parquet(f"{scratch}/a.parquet")
    assert count() != first and len(made) == 2
