"""Read-side queries over the order wide table (A5-A11, F2-F4, L1-L3, P13-P14,
S4-S7, T1-T5), over the stored, day-partitioned wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.misc import exclude_fields
from rillet.functions.text import fuzzy_any, highlight, match_all, match_any
from rillet.operators import aggregates, paging, predicates, search
from rillet.plans.orders import order_docs, stored_wide
from rillet.sources import adapters
from rillet.sources.tables import table

# Query parameters of the registered read-side queries.
STATS_ITEM = "widget"
DETAIL_ITEM = "red widget"
ANY_ITEM = "red widget"
FUZZY_TERM = "widgit"
HIGHLIGHT_TAGS = ("<font color='red'>", "</font>")
MISSING_DAY = "1900-01-01"


def _money(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def stats_by_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.stats_by_item(stored_wide(spark, sf_dir), STATS_ITEM, None, "gender")


def stats_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.stats_by_item(stored_wide(spark, sf_dir), STATS_ITEM, None, "age")


def stats_unknown_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown type has no rows, beside the known ones."""
    return aggregates.stats_rows(stored_wide(spark, sf_dir), STATS_ITEM, None,
                                 ["gender", "age", "region"])


def newest_day(spark: SparkSession, sf_dir: str) -> str:
    """The newest order day, 'yyyy-MM-dd' (one column is read)."""
    day = table(spark, sf_dir, "orders", "o_orderdate").agg(F.max("o_orderdate")).first()[0]
    return MISSING_DAY if day is None else day.strftime("%Y-%m-%d")


def stats_by_age_band_day(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    date = date or newest_day(spark, sf_dir)
    return aggregates.stats_by_item(stored_wide(spark, sf_dir, date), STATS_ITEM, date, "age")


def stats_by_gender_day(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    date = date or newest_day(spark, sf_dir)
    return aggregates.stats_by_item(stored_wide(spark, sf_dir, date), STATS_ITEM, date, "gender")


def detail_by_item(spark: SparkSession, sf_dir: str, page_no: int = 1, page_size: int = 20,
                   date: str | None = None, item: str = DETAIL_ITEM) -> DataFrame:
    """The detail search: one item, on one day if ``date`` is given, a page of hits."""
    page = search.detail_by_item(stored_wide(spark, sf_dir, date), item, page_no, page_size,
                                 date=date)
    return page.select(*[_money(c) if c in ("order_price", "total_amount") else F.col(c)
                         for c in page.columns])


def detail_by_item_day(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    return detail_by_item(spark, sf_dir, date=date or newest_day(spark, sf_dir), item=STATS_ITEM)


def detail_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.detail_total(stored_wide(spark, sf_dir), DETAIL_ITEM)


def missing_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day with no partition reads as empty: total 0."""
    return search.detail_total(stored_wide(spark, sf_dir, MISSING_DAY), DETAIL_ITEM, MISSING_DAY)


def term_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir)
    return w.where(predicates.term("user_age", 30)).select("detail_id", "user_age")


def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir)
    return w.where(predicates.range_("split_total_amount", gte=1000, lte=2000)) \
        .select("detail_id", _money("split_total_amount"))


def bool_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir)
    cond = predicates.bool_query(
        must=[match_all("sku_name", STATS_ITEM)],
        filter=[predicates.term("user_gender", "M")],
        must_not=[predicates.term("order_status", "F")],
        should=[predicates.range_("user_age", gte=30, lte=50)])
    return w.where(cond).select("detail_id", "sku_name", "user_gender", "order_status")


def exclude_fields_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir).select("detail_id", "order_id", "sku_name", "user_age",
                                         "user_gender", "province_name")
    return exclude_fields(w, ["user_age"])


def sort_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir).select("detail_id", "split_total_amount")
    p = paging.page(w, [F.desc("split_total_amount"), F.asc("detail_id")], page_no=3, page_size=10)
    return p.select("detail_id", _money("split_total_amount"))


def point_get(spark: SparkSession, sf_dir: str, detail_id: int = 1001) -> DataFrame:
    """One document by its day's index and id; the day is that of its order."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    row = o.where(F.col("o_orderkey") == detail_id // 1000).select("o_orderdate").first()
    day = MISSING_DAY if row is None or row[0] is None else row[0].strftime("%Y-%m-%d")
    w = stored_wide(spark, sf_dir, day)
    return w.where(F.col("detail_id") == F.lit(detail_id)).select(
        "detail_id", "order_id", "sku_name", _money("split_total_amount"))


def read_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row (match_all); callers page with L2."""
    return stored_wide(spark, sf_dir).select("detail_id", "order_id", "sku_id", "create_time")


def max_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.max_agg(stored_wide(spark, sf_dir), "user_age", "max_age")


def group_count_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_count_top(stored_wide(spark, sf_dir), "user_age", 10)


def nested_avg_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = order_docs(stored_wide(spark, sf_dir), adapters.part_dim(spark, sf_dir))
    out = aggregates.nested_avg_topk(docs, "items", "name", "total_amount", 10, "brand")
    return out.select("brand", "doc_count", F.round(F.col("avg_measure").cast("double"), 6)
                      .alias("avg_amount"))


def match_any_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir)
    return w.where(match_any("sku_name", ANY_ITEM)).select(
        "detail_id", highlight("sku_name", ANY_ITEM, *HIGHLIGHT_TAGS).alias("sku_name"))


def fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir)
    return w.where(fuzzy_any("sku_name", FUZZY_TERM, 2)).select("detail_id", "sku_name")


def bm25_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = stored_wide(spark, sf_dir)
    r = search.bm25_rank(w, "sku_name", ANY_ITEM, "detail_id", 100)
    return r.select("detail_id", "sku_name", F.round("score", 6).alias("score"))


def fuzzy_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchanged neighbours are one edit."""
    w = stored_wide(spark, sf_dir)
    return w.where(fuzzy_any("sku_name", "wdiget", 1)).select("detail_id", "sku_name")


def highlight_han(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: ideographs are tokens of their own, also inside a run of others."""
    w = stored_wide(spark, sf_dir)
    name = F.concat(F.lit("天天行动 "), "sku_name")
    return w.select("detail_id", highlight(name, "行动 WIDGET").alias("sku_name"))
