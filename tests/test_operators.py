"""Routing, change records, dedup, scalar and partitioner cases (hand-written
records for each rule of the reference's jobs and read side)."""

import json

import pytest
from pyspark.sql import functions as F

from rillet.functions import json as jf
from rillet.functions.misc import copy_fields, zip_map
from rillet.functions.time import age_years, day_of, hour_of, split_datetime
from rillet.operators import aggregates, dedup, routing
from rillet.operators.partitioner import route_partition
from rillet.schemas import DAU_INFO_FIELDS


def _raw(spark, recs):
    rows = [(r if isinstance(r, str) else json.dumps(r), i) for i, r in enumerate(recs)]
    return routing.parse_log(spark.createDataFrame(rows, "value string, seq long"))


def _page(**extra):
    rec = {"common": {"mid": "m1", "uid": "1", "ar": "3"}, "page": {"page_id": "home"}, "ts": 1000}
    rec.update(extra)
    return rec


ACT = [{"action_id": "a1", "ts": 1}, {"action_id": "a2", "ts": 2}]
DIS = [{"item": "1"}, {"item": "2"}, {"item": "3"}]


def test_error_route_emits_only_err(spark):
    p = _raw(spark, [_page(err={"code": 7, "msg": "x"})])
    errs = routing.error_route(p).collect()
    assert len(errs) == 1 and json.loads(errs[0]["err"]) == {"code": 7, "msg": "x"}
    assert routing.page_route(p).count() == 0
    assert routing.start_route(p).count() == 0


def test_action_and_display_routes(spark):
    p = _raw(spark, [_page(actions=ACT, displays=DIS)])
    assert routing.page_route(p).count() == 1
    assert routing.action_route(p).count() == 2
    assert routing.display_route(p).count() == 3
    assert routing.display_route(p, compat=True).count() == 6
    p0 = _raw(spark, [_page(displays=DIS)])
    assert routing.display_route(p0).count() == 3
    assert routing.display_route(p0, compat=True).count() == 0
    row = routing.page_route(p).first()
    assert (row["mid"], row["province_id"], row["page_id"], row["ts"]) == ("m1", "3", "home", 1000)


def test_page_and_start_both_routes(spark):
    p = _raw(spark, [_page(start={"entry": "icon", "loading_time": 5})])
    assert routing.page_route(p).count() == 1
    assert routing.start_route(p).first()["loading_time"] == 5


def test_malformed_goes_to_quarantine(spark):
    p = _raw(spark, ["{not json", {"common": {"mid": "m"}}])
    assert routing.quarantine(p).count() == 2
    counts = {r["route"]: r["rows"] for r in routing.route_counts(p).collect()}
    assert counts["page"] == 0


def test_cdc_op_mapping_and_dim_tombstone(spark):
    types = ["bootstrap-start", "bootstrap-insert", "insert", "update", "delete",
             "bootstrap-complete"]
    recs = spark.createDataFrame([("user_info", t, json.dumps({"id": i}), i)
                                  for i, t in enumerate(types)],
                                 "table string, type string, data string, seq long")
    ops = routing.cdc_ops(recs)
    assert [r["op"] for r in ops.orderBy("seq").collect()] == ["I", "I", "U", "D"]
    cfg = spark.createDataFrame([("user_info", "dim"), ("user_info", "fact")],
                                "table_name string, role string")
    topics = sorted(r["topic"] for r in routing.fact_route(ops, cfg).collect())
    assert topics == ["DWD_USER_INFO_D", "DWD_USER_INFO_I", "DWD_USER_INFO_I", "DWD_USER_INFO_U"]
    d = spark.createDataFrame([("user_info", "insert", '{"id": 5}', 1),
                               ("user_info", "delete", '{"id": 5}', 2)],
                              "table string, type string, data string, seq long")
    dops = routing.cdc_ops(d)
    assert routing.dim_route(dops, cfg).count() == 0
    kept = routing.dim_route(dops, cfg, compat=True).collect()
    assert len(kept) == 1 and kept[0]["dim_key"] == "DIM:USER_INFO:5" and kept[0]["op"] == "D"


DAY1, DAY2 = 86400000 * 19723, 86400000 * 19724  # 2024-01-01, 2024-01-02 (UTC)


def _pl(spark, rows):
    return spark.createDataFrame(
        [(m, t, s, None, "home") for m, t, s in rows],
        "mid string, ts long, seq long, last_page_id string, page_id string")


def test_daily_active_dedup_keeps_first(spark):
    pl = _pl(spark, [("m1", DAY1 + 5000, 2), ("m1", DAY1 + 1000, 1), ("m1", DAY2 + 1, 3),
                     ("m2", DAY1 + 7, 4)])
    rows = dedup.daily_active(pl).collect()
    got = sorted((r["dt"], r["mid"], r["ts"]) for r in rows)
    assert got == [("2024-01-01", "m1", DAY1 + 1000), ("2024-01-01", "m2", DAY1 + 7),
                   ("2024-01-02", "m1", DAY2 + 1)]


def test_dau_hours_fill_and_previous_day(spark):
    dau = spark.createDataFrame([("2024-01-01", "03", "a"), ("2024-01-02", "03", "b"),
                                 ("2024-01-02", "05", "c")], "dt string, hr string, mid string")
    out = {(r["dt"], r["hr"]): r for r in aggregates.dau_hours(dau, "2024-01-02").collect()}
    assert len(out) == 24
    assert out[("2024-01-02", "03")]["dau_td"] == 1 and out[("2024-01-02", "03")]["dau_yd"] == 1
    assert out[("2024-01-02", "05")]["dau_yd"] == 0 and out[("2024-01-02", "00")]["dau_td"] == 0
    assert out[("2024-01-02", "00")]["dau_total"] == 2
    assert aggregates.day_total(dau, "1999-01-01").first()["dau_total"] == 0


def test_age_formula(spark):
    df = spark.createDataFrame([("2000-02-29", "2001-02-28"), ("2000-02-29", "2001-03-01")],
                               "b string, n string")
    ages = [r[0] for r in df.select(age_years(F.to_date("b"), F.to_date("n"))).collect()]
    assert ages == [0, 1]


def _wide(spark, rows):
    from decimal import Decimal
    rows = [(n, a, g, Decimal(v), "2024-01-01") for n, a, g, v in rows]
    return spark.createDataFrame(
        rows, "sku_name string, user_age int, user_gender string, split_total_amount decimal(18,2), "
              "create_date string")


def test_stats_bands_labels_and_unknown(spark):
    w = _wide(spark, [("red widget", 29, "M", 1), ("red widget", 30, "F", 2),
                      ("red widget", 50, "X", 4), ("red widget", 51, "M", 8),
                      ("blue bolt", 20, "M", 100)])
    bands = {r["name"]: r["value"] for r in aggregates.stats_by_item(w, "widget", None, "age").collect()}
    assert bands == {"30岁以下": 1.0, "30-50岁": 6.0, "50岁以上": 8.0}
    g = sorted((r["name"], r["value"]) for r in
               aggregates.stats_by_item(w, "widget", None, "gender").collect())
    assert g == [("女", 2.0), ("女", 4.0), ("男", 9.0)]
    assert aggregates.stats_by_item(w, "widget", None, "other").count() == 0
    empty = aggregates.stats_by_item(w, "widget", "1999-01-01", "age").collect()
    assert [r["value"] for r in empty] == [0.0, 0.0, 0.0]


def test_json_members_and_maps(spark):
    s = '{"et":"kanqiu_client_join","vtm":1435898329434,"body":{"client":"866963024862254"}}'
    df = spark.createDataFrame([(s,)], "v string")
    r = df.select(jf.member("v", "$.et").alias("et"), jf.member("v", "$.vtm", "bigint").alias("vtm"),
                  jf.member("v", "$.body.client").alias("c")).first()
    assert (r["et"], r["vtm"], r["c"]) == ("kanqiu_client_join", 1435898329434, "866963024862254")
    m = spark.range(1).select(F.to_json(F.create_map(F.lit("1"), F.create_map(F.lit("1"), F.lit("1.1"))))
                              .alias("j")).first()["j"]
    assert json.loads(m) == {"1": {"1": "1.1"}}
    z = spark.range(1).select(zip_map(F.array(*map(F.lit, ["Alice", "Bob", "Cindy"])),
                                      F.array(*map(F.lit, [10, 3, 8]))).alias("m")).first()["m"]
    assert z == {"Alice": 10, "Bob": 3, "Cindy": 8}


def test_copy_fields_and_time_helpers(spark):
    pl = spark.createDataFrame([("101", "m1001", "1001", 0)],
                               "province_id string, mid string, user_id string, ts long")
    out = copy_fields(pl, DAU_INFO_FIELDS).first()
    assert (out["province_id"], out["mid"], out["user_id"], out["ts"]) == ("101", "m1001", "1001", 0)
    assert out["brand"] is None
    r = spark.range(1).select(day_of(F.lit(0)).alias("d"), hour_of(F.lit(0), "Asia/Shanghai").alias("h"),
                              *split_datetime(F.lit("2024-01-02 13:04:05"))).first()
    assert (r[0], r[1], r[2], r[3]) == ("1970-01-01", "08", "2024-01-02", "13")


def test_explicit_partitioner(spark):
    df = spark.createDataFrame([("nba",), ("cba",), ("wnba",), ("nba",)], "k string")
    out = route_partition(df, "k", {"cba": 0, "wnba": 1, "nba": 2}) \
        .select("k", F.col("partition_id").alias("p")).distinct().collect()
    assert sorted((r["k"], r["p"]) for r in out) == [("cba", 0), ("nba", 2), ("wnba", 1)]
    bad = spark.createDataFrame([("nhl",)], "k string")
    with pytest.raises(Exception):
        route_partition(bad, "k", {"cba": 0}, unknown="raise").collect()
