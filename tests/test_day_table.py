"""Day tables: replays, crashes, order of batches, odd partition values, deletes, compaction."""

import pytest
from pyspark.sql import functions as F

from rillet.sources.day_table import DayTable

SCHEMA = "id long, dt string, seq long, v int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def with_setting(spark, name, value, run):
    spark.conf.set(name, value)
    try:
        run()
    finally:
        spark.conf.unset(name)


def content(table):
    return sorted((r.id, r.dt or "", r.v) for r in table.read().collect())


@pytest.fixture()
def table(spark, scratch):
    return DayTable(spark, f"{scratch}/t", ["id"], ["dt"], seq="seq")


def test_an_older_row_never_replaces_a_newer_one(spark, table):
    table.upsert(rows(spark, (1, "d1", 9, 90)))
    table.upsert(rows(spark, (1, "d1", 3, 30), (2, "d1", 1, 10)))
    assert content(table) == [(1, "d1", 90), (2, "d1", 10)]


def test_without_seq_the_later_write_wins(spark, scratch):
    t = DayTable(spark, f"{scratch}/t", ["id"], ["dt"])
    for v in (1, 2, 3):
        t.upsert(rows(spark, (1, "d1", 0, v)))
    assert content(t) == [(1, "d1", 3)]


def test_a_batch_delivered_again_replaces_itself(spark, table):
    table.upsert(rows(spark, (1, "d1", 1, 1), (2, "d1", 1, 2)), "b-0")
    for _ in range(2):
        table.upsert(rows(spark, (1, "d1", 2, 11), (3, "d2", 2, 3)), "b-1")
        assert content(table) == [(1, "d1", 11), (2, "d1", 2), (3, "d2", 3)]
    table.compact()
    table.upsert(rows(spark, (1, "d1", 2, 11), (3, "d2", 2, 3)), "b-1")  # it is in the days
    assert content(table) == [(1, "d1", 11), (2, "d1", 2), (3, "d2", 3)]


def test_a_crash_between_the_days_and_the_batches(spark, table, monkeypatch):
    """Compaction that ends after its first write leaves every row readable once."""
    table.upsert(rows(spark, (1, "d1", 1, 1), (2, "d1", 1, 2)))
    table.upsert(rows(spark, (1, "d1", 2, 11)))
    plain = DayTable._write

    def crash(self, frame, path, mode="static"):
        if path == self.batches:
            raise OSError("gone")
        plain(self, frame, path, mode)

    with monkeypatch.context() as m:
        m.setattr(DayTable, "_write", crash)
        with pytest.raises(OSError):
            table.compact()
    want = [(1, "d1", 11), (2, "d1", 2)]
    assert content(table) == want and table._waiting()
    table.compact()
    assert content(table) == want and not table._waiting()


@pytest.mark.parametrize("day", [None, "a:b", "{x,y}*", "a b/c=%", "__x"])
def test_odd_partition_values_keep_earlier_rows(spark, table, day):
    table.upsert(rows(spark, (7, day, 1, 7)))
    table.upsert(rows(spark, (8, day, 1, 8)))
    assert content(table) == [(7, day or "", 7), (8, day or "", 8)]
    assert [r.id for r in table.read_partition(dt=day).orderBy("id").collect()] == [7, 8]
    table.delete_where(F.col("id") == 7)
    assert content(table) == [(8, day or "", 8)]


def test_deletes(spark, table):
    table.upsert(rows(spark, (1, "d1", 1, 50), (2, "d1", 1, None), (3, "d1", 1, 1), (4, "d2", 1, 2)))
    table.delete_where(F.col("v") > 10)  # null: not true, so the row stays
    assert content_ids(table) == [2, 3, 4]
    table.delete_where(F.col("dt") == "d2")  # the partition is empty then
    assert content_ids(table) == [2, 3]
    table.upsert(rows(spark, (4, "d2", 2, 5)))
    assert content_ids(table) == [2, 3, 4]
    table.compact()
    assert content_ids(table) == [2, 3, 4]


def content_ids(table):
    return sorted(r.id for r in table.read().collect())


def test_compaction_keeps_rows_and_untouched_days(spark, scratch):
    table = DayTable(spark, f"{scratch}/t", ["id"], ["dt"], seq="seq", compact=8)
    table.upsert(rows(spark, (500, "d9", 0, 0)))
    table.compact()
    day = [f for f in spark.read.parquet(table.days).inputFiles() if "dt=d9" in f]
    for k in range(20):
        table.upsert(rows(spark, (k % 5, "d1", k, k), (100 + k, "d2", k, k)), f"b-{k}")
        assert len(table._waiting()) < 8
    want = sorted([(k % 5, "d1", k) for k in range(15, 20)] + [(100 + k, "d2", k) for k in range(20)]
                  + [(500, "d9", 0)])
    assert content(table) == want
    table.compact()
    assert not table._waiting() and content(table) == want
    assert [f for f in spark.read.parquet(table.days).inputFiles() if "dt=d9" in f] == day
    assert "Aggregate" not in table.read()._jdf.queryExecution().executedPlan().toString()
    again = DayTable(spark, f"{scratch}/t", ["id"], ["dt"], seq="seq")  # schema from the files
    assert content(again) == want


def test_only_a_missing_table_reads_as_empty(spark, scratch):
    schema = rows(spark, (1, "d", 1, 1)).schema
    t = DayTable(spark, f"{scratch}/t", ["id"], ["dt"], schema=schema)
    assert content(t) == [] and not t.exists() and t.touched_rows(rows(spark, (1, "d", 1, 1))) is None
    t.delete_where(F.lit(True))
    t.upsert(spark.createDataFrame([], SCHEMA))
    assert content(t) == []
    with pytest.raises(ValueError):
        DayTable(spark, f"{scratch}/u", ["id"], ["dt"]).read()


def test_a_write_does_not_rewrite_the_table(spark, table):
    table.upsert(rows(spark, *((k, f"d{k % 3}", 1, k) for k in range(3000))), "a")
    table.upsert(rows(spark, (1, "d1", 2, -1)), "b")
    count = {n: spark.read.parquet(f"{table.batches}/__batch={n}").count() for n in "ab"}
    assert count == {"a": 3000, "b": 1}


def test_a_day_is_written_by_many_tasks(spark, table):
    data = [(k, "hot" if k % 10 else f"old{k % 50}", 1, k) for k in range(4000)]
    with_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false",
                 lambda: table.upsert(rows(spark, *data), "a"))
    files = spark.read.parquet(f"{table.batches}/__batch=a").where(
        "dt = 'hot'").select(F.input_file_name()).distinct().count()
    assert files > 4


def test_partition_and_key_filters_reach_the_scan(spark, table):
    for k in range(3):
        table.upsert(rows(spark, (k, f"d{k}", 1, k)))
    frame = table.read_partition(dt="d1").where("id = 1")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,1)" in plan and "PartitionFilters: [isnotnull(dt" in plan
    assert [r.v for r in frame.collect()] == [1]


def test_folders_do_not_grow_with_the_partition_values(spark, scratch):
    kept = DayTable(spark, f"{scratch}/many", ["id"], ["band"], seq="seq", folders=4)
    rows = spark.range(300).select("id", F.col("id").cast("string").alias("band"), F.lit(1).alias("seq"))
    kept.upsert(rows)
    kept.upsert(rows.where("id < 10").withColumn("seq", F.lit(2)))
    kept.delete_where(F.col("id") >= 200)
    kept.delete_where(F.col("band") == "7")
    kept.upsert(rows.where("id = 250").withColumn("seq", F.lit(0)))  # older than what was deleted
    got = {r.id: (r.band, r.seq) for r in kept.read().collect()}
    assert got == {k: (str(k), 2 if k < 10 else 1) for k in range(200) if k != 7}
    assert [r.id for r in kept.read_partition(band="12").collect()] == [12]
    touched = kept.touched_rows(rows.where("id = 12"))
    assert touched.columns == ["id", "band", "seq"] and touched.where("id = 12").count() == 1
    assert len({f.rsplit("/", 2)[1] for f in spark.read.parquet(kept.days).inputFiles()}) <= 4
