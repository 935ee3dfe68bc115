"""What grows with the tables: exchanges of order lines, derivations of replayed records,
parts in which hits meet."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from rillet import session
from rillet.operators import inverted_index, paging
from rillet.plans import orders, streams
from rillet.sources import adapters, day_table
from rillet.sources.day_table import DayTable
from rillet.streaming.sources import in_slices


def tables(spark, root):
    day = dt.datetime(2024, 1, 1)
    made = {
        "orders": ([(k, k % 3, "O", 10.0 + k, day + dt.timedelta(days=k)) for k in range(8)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"),
        "lineitem": ([(k % 8, k // 8, k % 5, 1, day, 5.0, 1.0, 0.1, 0.0, "N", "O") for k in range(24)],
                     "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz, "
                     "l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string"),
        "part": ([(k, f"name {k}", 2.0, "b", "t") for k in range(4)],
                 "p_partkey bigint, p_name string, p_retailprice double, p_brand string, p_type string"),
        "customer": ([(k, k) for k in range(3)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(k, f"n{k}", 0) for k in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "events": ([(k, day + dt.timedelta(hours=k), k % 3, "view", 1.0, '{"k":1}') for k in range(90)],
                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")}
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_order_lines_move_twice_where_nothing_is_broadcast(spark, scratch):
    sf = tables(spark, f"{scratch}/sf")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        wide = orders.order_wide(spark, sf)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert wide.count() == 24 and wide.where("sku_name is null").count() == 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # lines by order and by part; order days, orders, customers, users and parts once each; orders by id
    assert plan.count("Exchange hashpartitioning") <= 8


def test_chunks_of_a_replay_read_records_derived_once(spark, scratch):
    sf, seen = tables(spark, f"{scratch}/sf"), []
    streams._dau_replay(spark, sf, f"{scratch}/run", lambda chunks: seen.extend(chunks) or [])
    assert sum(c.count() for c in seen) == 90
    assert all("/run/" in f for c in seen for f in c.inputFiles())


def test_hits_meet_in_parts_of_bounded_size(spark, scratch, monkeypatch):
    monkeypatch.setattr(inverted_index, "TASK_DOCS", 10)
    docs = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "red widget").otherwise("blue").alias("t"))
    inverted_index.build(docs, "id", "t", f"{scratch}/index")
    index = inverted_index.Index(spark, f"{scratch}/index")
    hits = index.fuzzy("widgit")
    assert hits.rdd.getNumPartitions() == 6
    assert {r.id for r in hits.collect()} == set(range(0, 60, 2))
    monkeypatch.setattr(inverted_index, "FOUND_TERMS", 0)  # so many terms near that they are joined
    assert {r.id for r in index.fuzzy("widgit").collect()} == set(range(0, 60, 2))
    stats = index.stats.first()
    assert (stats["n_docs"], stats["avgdl"]) == (60, 1.5)


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def test_the_wide_table_is_written_in_passes_that_leave_no_shuffle_files(spark, scratch, monkeypatch):
    sf = tables(spark, f"{scratch}/sf")
    want = sorted(orders.order_wide(spark, sf).collect(), key=str)
    size = session.stored_bytes(spark, f"{sf}/orders.parquet", f"{sf}/lineitem.parquet")
    monkeypatch.setattr(session, "PASS_BYTES", size // 2 + 1)
    assert adapters.order_passes(spark, sf) == [(0, 2), (1, 2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffle_files(spark)
        wide = orders.stored_wide(spark, sf)
        assert not shuffle_files(spark) - before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(wide.select(*orders.WIDE_COLUMNS).collect(), key=str) == want and len(want) == 24


def test_passes_hold_every_row_once(spark):
    rows = spark.createDataFrame([(None,), ("7",), ("7",), ("x",), ("x",), ("8",)], "k string")
    parts = [rows.where(session.in_pass("k", p, 4)).collect() for p in range(4)]
    assert sorted(str(r.k) for part in parts for r in part) == ["7", "7", "8", "None", "x", "x"]
    assert all(len({k for k in range(4) for r in parts[k] if r.k == v}) == 1 for v in ("7", "x", None))
    numbers = spark.sql("select 7 as i, 7L as l, 7.00 as d")
    assert sum(numbers.where(session.in_pass("i", p, 4) & session.in_pass("l", p, 4)
                             & session.in_pass("d", p, 4)).count() for p in range(4)) == 1


def test_an_ordered_copy_leaves_no_shuffle_files(spark, scratch):
    before = shuffle_files(spark)
    order = [F.desc("v"), F.asc("id")]
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("v"))
    paging.write_ordered(rows, order, f"{scratch}/o", 4)
    assert not shuffle_files(spark) - before
    assert paging.Ordered(spark, f"{scratch}/o", order, rows.schema).total == 3000


def test_an_index_in_passes_is_the_index_in_one(spark, scratch, monkeypatch):
    docs = spark.createDataFrame([(k % 25, f"red {'widget ' * (k % 3)}n{k % 4}") for k in range(25)]
                                 + [(3, "red n3"), (None, "red one"), (None, "red one"), (90, None)], "id bigint, t string")
    docs.write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    before = shuffle_files(spark)
    inverted_index.build(docs, "id", "t", f"{scratch}/one")
    plan = inverted_index._postings(docs, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    monkeypatch.setattr(inverted_index, "PASS_DOCS", 7)
    inverted_index.build(docs, "id", "t", f"{scratch}/many")
    assert not shuffle_files(spark) - before
    one, many = (inverted_index.Index(spark, f"{scratch}/{name}") for name in ("one", "many"))
    for of in ("postings", "terms", "deletes", "stats"):
        rows = [sorted(getattr(x, of).drop("len").collect(), key=str) for x in (one, many)]
        assert rows[0] == rows[1] and rows[0]
        assert getattr(one, of).schema == getattr(many, of).schema
    held = {(r.term, r.id): r.tf for r in many.postings.collect()}
    assert held["red", None] == 2 and held["red", 3] == 2 and held["widget", 2] == 2


def test_the_order_stream_takes_its_records_in_slices_and_drops_them(spark, scratch, monkeypatch):
    sf = tables(spark, f"{scratch}/sf")
    size = session.stored_bytes(spark, f"{sf}/orders.parquet", f"{sf}/lineitem.parquet")
    monkeypatch.setattr(session, "PASS_BYTES", size // 2 + 1)
    monkeypatch.setattr(streams, "scratch_path", lambda *_: f"{scratch}/run")
    parts, runs = [], []
    split, replay = streams._order_slices, streams.replay
    monkeypatch.setattr(streams, "_order_slices", lambda *a: parts.extend(split(*a)) or parts)
    monkeypatch.setattr(streams, "replay", lambda steps, once, done: runs.append(replay(steps, once, done)))
    rows = streams.stream_order_join(spark, sf)
    assert runs == [6] and len(parts) == 6
    want = orders.order_wide(spark, sf).select("detail_id", "order_id", "create_date", "user_gender", "province_name")
    assert sorted(rows.drop("split_total_amount").collect()) == sorted(want.collect()) and rows.count() == 24
    left = {name: glob.glob(f"{scratch}/run/{name}/**/*.parquet", recursive=True)
            for name in ("orders", "details", "all-orders", "all-details")}
    assert not any(left.values())


def test_slices_hold_every_record_once(spark, scratch):
    rows = spark.range(40).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("t"))
    slices = in_slices([rows.where("id < 25"), rows.where("id >= 25")], "t", [10, 30, 20], f"{scratch}/s")
    got = [sorted(r.id for r in s.collect()) for s in slices]
    assert sorted(sum(got, [])) == list(range(40))
    assert got[0] == [*range(10), 10, 20, 30] and got[1] == list(range(11, 20))
    assert slices[0].dtypes == rows.dtypes


def test_a_day_table_merges_only_what_stands_twice(spark, scratch, monkeypatch):
    t = DayTable(spark, f"{scratch}/t", ["id"], ["dt"], compact=4)
    day = F.concat(F.lit("d"), F.floor(F.col("id") / 10).cast("string"))
    rows = spark.range(30).select("id", F.when(F.col("id") != 29, day).alias("dt"), F.lit(1).alias("v"))
    t.upsert(rows.union(rows), "a")  # rows that come twice
    stored = spark.read.parquet(f"{scratch}/t/batches")
    assert stored.count() == 30 == t.read().count()
    assert "Aggregate" not in t.read()._jdf.queryExecution().executedPlan().toString()
    t.upsert(rows.where("id in (3, 29)").withColumn("v", F.lit(2)), "b")
    want = {(k, 2 if k in (3, 29) else 1) for k in range(30)}
    assert {(r.id, r.v) for r in t.read().collect()} == want and t.read().count() == 30
    monkeypatch.setattr(day_table, "NAMED", 1)  # too many to be named: all are merged
    assert {(r.id, r.v) for r in t.read().collect()} == want and t.read().count() == 30
    monkeypatch.setattr(day_table, "STEP_ROWS", 12)
    assert len(t._steps(t._rows(t.batches))) == 4
    t.compact()
    assert not t._waiting() and {(r.id, r.v) for r in t.read().collect()} == want
