"""Keyed-document operators on the user and movie fixtures of the reference's
search demos (expected values worked out by reading the demo inputs)."""

from pyspark.sql import functions as F

from rillet.functions.text import fuzzy_any, highlight, match_all
from rillet.operators import aggregates, mutations, paging, predicates

USERS = [  # seq, id, name, age, sex (bulk put order)
    (1, "1001", "zhangsan", 30, "男"), (2, "1002", "lisi", 30, "女"),
    (3, "1003", "wangwu", 40, "男"), (4, "1004", "wangwu1", 40, "女"),
    (5, "1005", "wangwu2", 50, "男"), (6, "1006", "wangwu3", 50, "男"),
    (7, "1007", "wangwu44", 60, "男"), (8, "1008", "wangwu555", 60, "男"),
    (9, "1001", "gf", 60, "男"),
]
SCHEMA = "seq int, id string, name string, age int, sex string"


def _users(spark):
    bulk = spark.createDataFrame(USERS, SCHEMA)
    empty = bulk.where(F.lit(False))
    return mutations.upsert(empty, bulk, "id", "seq")


def _ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_bulk_put_last_wins(spark):
    u = _users(spark)
    assert u.count() == 8
    r = u.where("id = '1001'").first()
    assert (r["name"], r["age"], r["sex"]) == ("gf", 60, "男")


def test_term_range_bool(spark):
    u = _users(spark)
    assert _ids(u.where(predicates.term("age", 30))) == ["1002"]
    assert _ids(u.where(predicates.range_("age", gte=40, lte=50))) == ["1003", "1004", "1005", "1006"]
    cond = predicates.bool_query(must=[predicates.term("age", 30), predicates.term("sex", "男")],
                                 must_not=[predicates.term("sex", "男")])
    assert u.where(cond).count() == 0
    # should alone: at least one must hold
    cond = predicates.bool_query(should=[predicates.term("age", 30), predicates.term("age", 40)])
    assert _ids(u.where(cond)) == ["1002", "1003", "1004"]


def test_fuzzy_and_highlight(spark):
    u = _users(spark)
    assert _ids(u.where(fuzzy_any("name", "wangwu", 2))) == ["1003", "1004", "1005", "1006", "1007"]
    h = u.where(match_all("name", "wangwu")).select(
        "id", highlight("name", "wangwu", "<font color='red'>", "</font>").alias("h")).collect()
    assert [(r["id"], r["h"]) for r in h] == [("1003", "<font color='red'>wangwu</font>")]


def test_sort_page_exclude_max_count(spark):
    u = _users(spark)
    order = [F.desc("age"), F.asc("id")]
    assert [r["id"] for r in u.orderBy(*order).collect()] == \
        ["1001", "1007", "1008", "1005", "1006", "1003", "1004", "1002"]
    assert "age" not in u.drop("age").columns and u.drop("age").count() == 8
    assert [r["id"] for r in paging.page(u, [F.asc("id")], 3, 1).collect()] == ["1003"]
    assert aggregates.max_agg(u, "age", "max_age").first()["max_age"] == 60
    rows = aggregates.group_count_top(u, "age", 10).collect()
    assert [(r["age"], r["doc_count"]) for r in rows] == [(60, 3), (40, 2), (50, 2), (30, 1)]


def test_partial_update_then_delete(spark):
    u = _users(spark)
    upd = spark.createDataFrame([("1001", "女", 10)], "id string, sex string, seq int")
    u2 = mutations.partial_update(u, upd, "id", ["sex"], "seq")
    r = u2.where("id = '1001'").first()
    assert (r["name"], r["age"], r["sex"]) == ("gf", 60, "女")
    ids = spark.createDataFrame([("1001",)], "id string")
    assert mutations.delete_ids(u2, ids, "id").count() == 7


MOVIES = [("001", "天天行动", 6.0, [("01", "啦啦啦"), ("01", "啦")]),
          ("002", "行动", 5.0, [("01", "啦啦啦"), ("01", "啦")])]
MSCHEMA = "id string, name string, doubanScore double, actorList array<struct<id:string,name:string>>"


def test_nested_avg_and_update_by_query(spark):
    m = spark.createDataFrame(MOVIES, MSCHEMA)
    rows = aggregates.nested_avg_topk(m, "actorList", "name", "doubanScore", 10, "actor").collect()
    assert [(r["actor"], r["doc_count"], r["avg_measure"]) for r in rows] == \
        [("啦", 2, 5.5), ("啦啦啦", 2, 5.5)]
    hits = m.where((F.col("doubanScore") >= 5.0) & match_all("name", "行动"))
    assert [r["id"] for r in hits.orderBy("doubanScore").limit(2).collect()] == ["002", "001"]
    upd = spark.createDataFrame([("002", "懂", 1)], "id string, name string, seq int")
    m2 = mutations.partial_update(m, upd, "id", ["name"], "seq")
    m3 = mutations.update_by_query(m2, match_all("name", "懂"), "actorList", 0, "name",
                                   F.lit("你好呀"))
    got = {r["id"]: r for r in m3.collect()}
    assert got["002"]["actorList"][0]["name"] == "你好呀"
    assert got["002"]["actorList"][1]["name"] == "啦"
    assert got["001"]["actorList"][0]["name"] == "啦啦啦"


def test_append_with_generated_id(spark):
    u = _users(spark).select("id", "name")
    new = spark.createDataFrame([("x1",), ("x2",)], "name string")
    out = mutations.append_with_id(u, new, "id", ["name"])
    assert out.count() == 10
    assert out.where(F.col("name").startswith("x")).select("id").distinct().count() == 2
