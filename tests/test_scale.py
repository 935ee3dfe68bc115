"""Plan-shape checks for the scale rules: hot keys are pre-combined before the
shuffle, and the day-window dashboard parameter scopes the scan."""

from pyspark.sql import functions as F

from rillet.operators import dedup
from rillet.plans import dashboard

SF = "/root/testdata/sf0.001"
DAY = 86400000 * 19723


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_device_dedup_is_partial_aggregate(spark):
    # one device holds 90% of the rows
    rows = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("m"), F.col("id").cast("string")))
        .otherwise(F.lit("hot")).alias("mid"),
        (F.lit(DAY) + F.col("id") * 1000).alias("ts"),
        F.col("id").alias("seq"),
        F.lit(None).cast("string").alias("last_page_id"),
        F.lit("home").alias("page_id"))
    out = dedup.daily_active(rows)
    plan = _plan(out)
    # map-side partial aggregate before the exchange: the hot key is combined per task
    assert "partial_min_by" in plan
    hot = out.where("mid = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["ts"] == DAY + 1000  # earliest row of the hot device
    assert out.count() == 2000 + 1


def test_dashboard_day_window(spark):
    all_days = dashboard.q01_pv(spark, SF).count()
    last7 = dashboard.q01_pv(spark, SF, days=7)
    assert last7.count() == 7 < all_days
    total = dashboard.q03_visit_total(spark, SF, days=7).first()["pv_count"]
    assert total == last7.agg(F.sum("pv")).first()[0]
    # the window start reaches the events scan as a parquet filter
    assert "GreaterThanOrEqual(ts," in _plan(last7)
    # same days and counts as filtering the whole history afterwards
    full = dashboard.q01_pv(spark, SF).orderBy(F.desc("dt")).limit(7)
    assert sorted(last7.collect()) == sorted(full.collect())


def _hot_rows(spark, n=6000):
    # device "hot" holds 90% of the rows over several minutes; some rows share a ts
    return spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("m"), (F.col("id") % 7).cast("string")))
        .otherwise(F.lit("hot")).alias("mid"),
        F.lit("2024-01-01").alias("dt"),
        (F.lit(DAY) + F.floor((F.col("id") * 7919 % n) * 100 / 3)).alias("ts"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("p"), (F.col("id") % 5).cast("string"))).alias("last_page_id"))


def test_chunked_sessions_match_plain_window(spark):
    from pyspark.sql import Window
    from rillet.operators.sessions import sessionize
    rows = _hot_rows(spark)
    w = (Window.partitionBy("mid", "dt").orderBy("ts", "seq")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    want = rows.withColumn("session_no",
                           F.sum(F.col("last_page_id").isNull().cast("bigint")).over(w))
    got = sessionize(rows)
    plan = _plan(got)
    # the ordering window is keyed by the time chunk as well, never by (mid, dt) alone
    assert "__chunk" in plan
    assert want.exceptAll(got.select(*want.columns)).count() == 0
    assert got.count() == rows.count()


def test_category_top_n_remainder(spark):
    full = {r["name"]: r["value"] for r in dashboard.q13_category(spark, SF, num=1000).collect()}
    assert dashboard.OTHER_LABEL not in full  # every category fits: no remainder row
    top3 = {r["name"]: r["value"] for r in dashboard.q13_category(spark, SF, num=3).collect()}
    assert len(top3) == min(4, len(full) + 1)
    best = sorted(full.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert all(abs(top3[k] - v) < 1e-6 for k, v in best)
    assert abs(sum(top3.values()) - sum(full.values())) < 1e-6
    plan = _plan(dashboard.q13_category(spark, SF, num=3))
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_day_table_files_are_key_ordered(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    from rillet.sources.day_table import DayTable
    sink = DayTable(spark, f"{scratch}/kt", ["id"], ["dt"], seq="seq")
    rows = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("id"),
        F.when(F.col("id") % 5 == 0, "2024-01-02").otherwise("2024-01-01").alias("dt"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    sink.upsert(rows)
    sink.upsert(rows.where("id < 100").withColumn("v", F.lit(-1)).withColumn("seq", F.lit(10**6)))
    files = glob.glob(f"{scratch}/kt/batches/*/dt=*/*.parquet")
    assert files
    for f in files:
        ids = pq.read_table(f, columns=["id"]).column("id").to_pylist()
        assert ids == sorted(ids)
    got = sink.get(id=42)
    assert "EqualTo(id,42)" in _plan(got)
    assert [r["v"] for r in got.collect()] == [-1]
    assert sink.read().count() == 5000


def test_dau_hours_for_a_date_reads_two_days(spark):
    from rillet.plans.dau import dau_realtime_hours
    full = dau_realtime_hours(spark, SF)
    days = sorted(r["dt"] for r in full.select("dt").distinct().collect())
    for date in (days[0], days[len(days) // 2], days[-1]):
        one = dau_realtime_hours(spark, SF, date)
        plan = _plan(one)
        assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
        assert sorted(one.collect()) == sorted(full.where(F.col("dt") == date).collect())


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from rillet.operators.joins import bounded_broadcast
    small = spark.range(10).select("id", F.lit("x").alias("s"))
    wide = spark.range(10).select("id", F.repeat(F.lit("y"), 1000).alias("s"))
    many = spark.range(50)
    probe = spark.range(100).select(F.col("id") % 10).withColumnRenamed("(id % 10)", "id")
    assert "BroadcastHashJoin" in _plan(probe.join(bounded_broadcast(small), "id"))
    for df, kw in ((wide, {"max_bytes": 5000}), (many, {"max_rows": 20})):
        hinted = bounded_broadcast(df, **kw)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert "BroadcastHashJoin" not in _plan(probe.join(hinted, "id"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
