"""Inverted index, fuzzy dictionary, fragments, deep pages, placement: odd input and plans."""

import random

import pytest
from pyspark.sql import functions as F

from rillet.functions.text import analyze, best_fragment, fragments, fuzzy_any, match_all, match_any, tokens
from rillet.operators import inverted_index, paging, search
from rillet.operators.partitioner import place_partitions


@pytest.fixture(scope="module")
def names(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    words += ["extraordinarily", "extraordinarly", "xetraordinarily", "〇", "年", "X1"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 7)))) for k in range(400)]
    rows += [(400 + k, "hot hot thing") for k in range(200)] + [(900, None), (901, ""), (902, "〇〇年 x1")]
    return spark.createDataFrame(rows, "id bigint, name string")


@pytest.fixture(scope="module")
def index(spark, names):
    from rillet.session import scratch_path
    path = scratch_path(spark, "test-index")
    inverted_index.build(names, "id", "name", path)
    return inverted_index.Index(spark, path)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("query", ["hot", "hot thing", "ab c", "〇〇", "〇年 X1", "nothing", "", "HOT ab"])
def test_rank_and_match_equal_the_scan(names, index, query):
    scan = search.bm25_rank(names, "name", query, "id", 1000)
    want = [(r.id, round(r.score, 9)) for r in scan.collect()]
    got = [(r.id, round(r.score, 9)) for r in index.rank(query, 1000).collect()]
    assert sorted(got) == sorted(want) and [s for _, s in got] == [s for _, s in want]
    assert ids(index.match_all(query)) == ids(names.where(match_all("name", query)))


@pytest.mark.parametrize("query,edits", [("abc", 2), ("bac", 1), ("extraordinarily", 2), ("a", 2), ("é", 1),
                                         ("hto thnig", 1), ("", 2), ("zzzzzz", 2), ("caéb", 2)])
def test_fuzzy_equals_the_scan(names, index, query, edits):
    assert ids(index.fuzzy(query, edits)) == ids(names.where(fuzzy_any("name", query, edits)))


def test_a_query_reads_its_terms_alone(index):
    plan = index._of(["hot"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,hot)" in plan or "In(term, [hot])" in plan
    rank = index.rank("hot thing", 5)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in rank and "TakeOrdered" in rank


def test_an_empty_index(spark, scratch):
    inverted_index.build(spark.createDataFrame([], "id bigint, name string"), "id", "name", scratch)
    empty = inverted_index.Index(spark, scratch)
    assert ids(empty.rank("a")) == ids(empty.match_all("a")) == ids(empty.fuzzy("a")) == []


def test_one_analyser(spark):
    for text in ["〇〇年", "Red-widget 々a1b", "漢字かな kana", "½ x²", "ａＢ", "𠀀𠀁 b"]:
        got = spark.createDataFrame([(text,)], "t string").select(tokens("t")).first()[0]
        assert analyze(text) == got
    df = spark.createDataFrame([("〇〇年",)], "t string")
    assert df.where(match_any("t", "〇〇")).count() == 1 == df.where(match_all("t", "年〇")).count()


def test_fragments(spark):
    long = "word " * 60
    rows = [(1, "One. Two the! the End?\nLast"), (2, long + "."), (3, "x" * 250), (4, ""), (5, None), (6, "...")]
    df = spark.createDataFrame(rows, "id int, t string")
    parts = {r.id: r.p for r in df.select("id", fragments("t").alias("p")).collect()}
    assert parts[1] == ["One.", " Two the!", " the End?\n", "Last"]
    assert all(len(p) <= 101 for p in parts[2]) and "".join(parts[2]) == long + "."
    assert parts[3] == ["x" * 100, "x" * 100, "x" * 50]
    assert parts[4] == [] and parts[5] is None and parts[6] == []
    best = {r.id: r.b for r in df.select("id", best_fragment("t", "THE end").alias("b")).collect()}
    assert (best[1].score, best[1].fragment) == (2, " the End?\n")
    assert best[2].score == 0 and best[4] is None and best[5] is None


def test_deep_pages(spark, scratch):
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 != 0, F.lit(7)).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    paging.write_ordered(rows, order, f"{scratch}/o", 6)
    ordered = paging.Ordered(spark, f"{scratch}/o", order, rows.schema)
    assert ordered.total == 5000
    for page in (1, 2, 100, 249, 250, 251):
        want = paging.page(rows, order, page, 20).collect()
        assert ordered.page(page, 20).collect() == want
    plan = ordered.page(200, 20)._jdf.queryExecution().executedPlan().toString()
    limits = [int(x.split(",")[0].split(")")[0]) for x in plan.split("limit=")[1:]]
    assert limits and max(limits) < 2000  # not the 4,000 rows before the page
    paging.write_ordered(rows.limit(0), order, f"{scratch}/e", 6)
    assert paging.Ordered(spark, f"{scratch}/e", order, rows.schema).page(3, 5).collect() == []


def test_rows_are_where_their_key_says(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 10 < 7, "hot").when(
        F.col("id") % 10 == 7, "cold").when(F.col("id") % 10 == 8, "new").alias("key"))
    placed = place_partitions(rows, "key", {"hot": 0, "cold": 1}, ["id"], width=3)
    seen = placed.withColumn("task", F.spark_partition_id()).groupBy("key").agg(
        F.collect_set("task").alias("tasks"), F.count(F.lit(1)).alias("n"))
    at = {r.key: (sorted(r.tasks), r.n) for r in seen.collect()}
    assert at == {"hot": ([0, 1, 2], 2100), "cold": ([3, 4, 5], 300),
                  "new": ([6, 7, 8], 300), None: ([6, 7, 8], 300)}
    assert placed.rdd.getNumPartitions() == 9
    with pytest.raises(Exception, match="unmapped partition key"):
        place_partitions(rows, "key", {"hot": 0}, ["id"], unknown="raise").count()
