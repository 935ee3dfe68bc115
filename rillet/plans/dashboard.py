"""Dashboard queries (Q1-Q15) over the page log and the order wide table.

The reference names these endpoints (parameters ``days``, ``num``) but holds no
server code for them; the formulas here are ours. ``days=None`` (the registered
form) covers every day of the tables; otherwise the last ``days`` days up to the
newest day of the input.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.time import day_of
from rillet.operators import joins
from rillet.operators.sessions import sessions
from rillet.sources import adapters
from rillet.sources.tables import table

TOP_N = 10

# Fixed labels of the dashboard: funnel steps and the remainder row of a top-n.
FUNNEL_STEPS = ("首页", "商品详情", "加购物车", "订单", "支付")
OTHER_LABEL = "其他"
# Page kinds of the test data that stand for the first three funnel steps.
FUNNEL_PAGES = ("view", "click", "purchase")
PAID_STATUS = "F"


def _since(spark: SparkSession, sf_dir: str, name: str, col: str, days: int | None) -> str | None:
    """First day of the last ``days`` days of a table, up to its own newest day. The
    newest day is one aggregate over the time column alone."""
    if days is None:
        return None
    last = table(spark, sf_dir, name, col).agg(F.max(F.to_date(col))).first()[0]
    return None if last is None else (last - timedelta(days=days - 1)).isoformat()


def _pages(spark: SparkSession, sf_dir: str, days: int | None = None) -> DataFrame:
    """Page rows with ``dt``; ``days`` keeps the last ``days`` days present. The bound
    reaches the events scan, so a 7-day dashboard does not read the whole history."""
    since = _since(spark, sf_dir, "events", "ts", days)
    return adapters.page_log(spark, sf_dir, since, province=False).withColumn("dt", day_of("ts"))


def _pct(part, whole) -> F.Column:
    """part * 100 / whole in double arithmetic (unrounded; rounding is display), null of none."""
    return F.try_divide(part.cast("double") * F.lit(100.0).cast("double"), whole.cast("double"))


def q01_pv(spark, sf_dir, days=None):
    return _pages(spark, sf_dir, days).groupBy("dt").agg(F.count(F.lit(1)).alias("pv"))


def q02_uv(spark, sf_dir, days=None):
    return _pages(spark, sf_dir, days).groupBy("dt").agg(F.count_distinct("mid").alias("uv"))


def q03_visit_total(spark, sf_dir, days=None):
    # one row a device, combined before the shuffle, instead of a row copied per distinct count
    per = _pages(spark, sf_dir, days).groupBy("mid").agg(
        F.count(F.lit(1)).alias("pages"), F.max(F.col("is_new") == "1").alias("new"))
    return per.agg(F.coalesce(F.sum("pages"), F.lit(0).cast("bigint")).alias("pv_count"),
                   F.count("mid").alias("uv_count"),
                   F.count_if(F.col("new") & F.col("mid").isNotNull()).alias("new_count"))


def q04_new_visit_stats(spark, sf_dir, days=None):
    p = _pages(spark, sf_dir, days)
    s = sessions(p)
    by = s.groupBy("is_new").agg(
        F.sum("pages").cast("double").alias("page_views"),
        F.count_distinct("mid").cast("double").alias("visitors"),
        _pct(F.count_if(F.col("pages") == 1), F.count(F.lit(1))).alias("bounce_rate"),
        (F.avg("duration_ms") / F.lit(1000.0).cast("double")).alias("avg_duration_s"),
        (F.sum("pages").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_pages"))
    long = by.select("is_new", F.expr(
        "stack(5, 'page_views', page_views, 'visitors', visitors, 'bounce_rate', bounce_rate, "
        "'avg_duration_s', avg_duration_s, 'avg_pages', avg_pages) as (field, v)"))
    return long.groupBy("field").agg(
        F.max(F.when(F.col("is_new") == "0", F.col("v"))).alias("old"),
        F.max(F.when(F.col("is_new") == "1", F.col("v"))).alias("new"))


def q05_channel_pv(spark, sf_dir, days=None):
    return _pages(spark, sf_dir, days).groupBy("channel").agg(F.count(F.lit(1)).alias("pv"))


def q06_channel_bounce(spark, sf_dir, days=None):
    s = sessions(_pages(spark, sf_dir, days))
    return s.groupBy("channel").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("pages") == 1).alias("bounces"),
        _pct(F.count_if(F.col("pages") == 1), F.count(F.lit(1))).alias("bounce_rate"))


def q07_page_path(spark, sf_dir, days=None):
    p = _pages(spark, sf_dir, days).where(F.col("last_page_id").isNotNull())
    return p.groupBy(F.col("last_page_id").alias("source"), F.col("page_id").alias("target")) \
        .agg(F.count(F.lit(1)).alias("value"))


def q07_page_nodes(spark, sf_dir, days=None):
    """Nodes of the page path: every page that a link starts or ends at."""
    links = q07_page_path(spark, sf_dir, days)
    return links.select(F.explode(F.array("source", "target")).alias("name")).distinct()


def _order_days(spark, sf_dir, days) -> str | None:
    return _since(spark, sf_dir, "orders", "o_orderdate", days)


def _orders(spark, sf_dir, days=None) -> DataFrame:
    """Orders of the last ``days`` days, like the pages they are set against."""
    o = adapters.order_info(spark, sf_dir, _order_days(spark, sf_dir, days))
    return o.select("id", "user_id", "order_status", "total_amount")


def q08_user_action_convert(spark, sf_dir, days=None):
    p = _pages(spark, sf_dir, days)
    o = _orders(spark, sf_dir, days)
    per = p.where(F.col("mid").isNotNull()).groupBy("mid").agg(
        *[F.max(F.col("page_id") == pg).alias(f"s{i}") for i, pg in enumerate(FUNNEL_PAGES)])
    counts = per.agg(*[F.count_if(f"s{i}").alias(f"s{i}") for i in range(len(FUNNEL_PAGES))])
    buyers = o.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.max(F.col("order_status") == PAID_STATUS).alias("paid"))
    ocounts = buyers.agg(F.count(F.lit(1)).alias("s3"), F.count_if("paid").alias("s4"))
    both = counts.unionByName(ocounts, allowMissingColumns=True) \
        .agg(*[F.max(f"s{i}").alias(f"s{i}") for i in range(5)])
    stack = ", ".join(f"{i + 1}, '{name}', s{i}" for i, name in enumerate(FUNNEL_STEPS))
    out = both.select(F.col("s0").alias("base"),
                      F.expr(f"stack(5, {stack}) as (step_no, step, users)"))
    return out.select("step_no", "step", "users",
                      _pct(F.col("users"), F.col("base")).alias("pct"))


def q09_user_paid(spark, sf_dir, days=None):
    active = _pages(spark, sf_dir, days).select(F.col("mid").try_cast("bigint").alias("uid")).distinct()
    paying = _orders(spark, sf_dir, days).where(F.col("order_status") == PAID_STATUS) \
        .select(F.col("user_id").alias("uid")).distinct().withColumn("paid", F.lit(True))
    j = active.join(paying, "uid", "left")
    return j.groupBy(F.coalesce("paid", F.lit(False)).alias("paid")) \
        .agg(F.count(F.lit(1)).alias("users"))


def q10_user_total(spark, sf_dir, days=None):
    p = _pages(spark, sf_dir, days)
    users = p.groupBy(F.col("mid").try_cast("bigint").alias("uid")) \
        .agg(F.max(F.col("is_new") == "1").alias("is_new"))
    o = _orders(spark, sf_dir, days)
    per_user = o.groupBy(F.col("user_id").alias("uid")).agg(F.sum("total_amount").alias("amount"))
    j = users.join(per_user, "uid", "full_outer")
    return j.agg(
        F.count_if(F.col("is_new").isNotNull()).alias("user_total"),
        F.count_if(F.col("amount").isNotNull()).alias("order_user_total"),
        F.count_if(F.col("is_new")).alias("new_user_count"),
        F.count_if(F.col("is_new") & F.col("amount").isNotNull()).alias("new_order_user_count"),
        (F.sum("amount").cast("double") / F.count_if(F.col("amount").isNotNull()).cast("double"))
        .alias("pct"))


def _sales(spark, sf_dir, days=None) -> DataFrame:
    """Order lines with their sku's brand and category: no order, user or province
    column is asked, so none of these is joined."""
    return adapters.order_detail(spark, sf_dir, _order_days(spark, sf_dir, days), sku=True)


def _sold_orders(spark, sf_dir, days=None) -> DataFrame:
    """Orders that have a line."""
    lines = table(spark, sf_dir, "lineitem", F.col("l_orderkey").alias("id"))
    return adapters.order_info(spark, sf_dir, _order_days(spark, sf_dir, days)).join(
        lines, "id", "left_semi")


def _top(df: DataFrame, key: str, n: int) -> DataFrame:
    agg = df.groupBy(F.col(key).alias("name")).agg(F.sum("split_total_amount").alias("amount"))
    return agg.orderBy(F.desc("amount"), F.asc("name")).limit(n) \
        .select("name", F.col("amount").cast("double").alias("value"))


def q11_spu(spark, sf_dir, num=TOP_N, days=None):
    return _top(_sales(spark, sf_dir, days), "sku_name", num)


def q12_tm(spark, sf_dir, num=TOP_N, days=None):
    return _top(_sales(spark, sf_dir, days), "tm_name", num)


def q13_category(spark, sf_dir, num=TOP_N, days=None):
    """Top-n categories plus one remainder row for all other categories.

    The top n come from a distributed top-k (TakeOrdered: each task keeps its n
    best, then they merge), never from a window over all categories in one
    task. The remainder is the per-category aggregate minus those n names
    (an anti join against at most ``num`` broadcast rows), summed; it is
    absent when there are no other categories.
    """
    s = _sales(spark, sf_dir, days)
    agg = s.groupBy(F.col("category_name").alias("name")) \
        .agg(F.sum("split_total_amount").alias("amount"))
    top = agg.orderBy(F.desc("amount"), F.asc("name")).limit(num)
    t = F.broadcast(top.select(F.col("name").alias("__top")))  # at most num rows
    rest = agg.join(t, agg["name"].eqNullSafe(t["__top"]), "left_anti") \
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 0).select(F.lit(OTHER_LABEL).alias("name"), "amount")
    return top.unionByName(rest).groupBy("name") \
        .agg(F.sum("amount").cast("double").alias("value"))


def q14_area(spark, sf_dir, days=None):
    o = joins.enrich_province(_sold_orders(spark, sf_dir, days), adapters.base_province(spark, sf_dir))
    return o.groupBy("province_name").agg(F.count(F.lit(1)).alias("order_count"))


def q15_order_total(spark, sf_dir, days=None):
    return _sold_orders(spark, sf_dir, days).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").cast("double").alias("order_amount"),
        F.count_distinct("user_id").alias("order_user"))


WEEK = 7


def last_week(query):
    """The query over the last 7 days of its input."""
    def run(spark, sf_dir):
        return query(spark, sf_dir, days=WEEK)
    return run
