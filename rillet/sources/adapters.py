"""Adapters: derive the domain records (page log, raw log JSON, dimensions, order
info/detail, change records) from the driver's TPC-H-like test tables.

These are fixed derivations so that Spark and the SQL oracle agree; the matching
SQL lives in ``rillet.plans.oracle_sql``. Every adapter is a lazy DataFrame over
the whole input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillet.functions.time import epoch_millis
from rillet.operators.ordered import chunked_previous
from rillet.session import in_pass, passes, stored_once
from rillet.sources.tables import table

# Fixed values of the change-record derivation (cycled by key).
CDC_TYPES = ["bootstrap-start", "bootstrap-insert", "insert", "update", "delete",
             "bootstrap-complete"]
CDC_TABLES = ["order_info", "user_info", "base_province"]
# Routing configuration used with the change records (a table may be in both sets).
FACT_TABLES = ["order_info", "user_info"]
DIM_TABLES = ["user_info", "base_province"]

USER_AS_OF = "2024-01-31"


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def page_log(spark: SparkSession, sf_dir: str, since: str | None = None,
             until: str | None = None, province: bool = True) -> DataFrame:
    """PageLog rows from events; ``province`` joins the customer for province_id.

    last_page_id = previous event type of the same user on the same day, so the
    first event of a user's day is a session-entry page. It is found per (user, day,
    minute) and carried over the minutes, so no task sorts a user's day. ``seq`` =
    event_id plays the role of the log offset (deterministic tie-break).

    ``since`` / ``until`` ('yyyy-MM-dd', until exclusive) keep whole days. The
    bounds are filters on the events scan itself (pushed to parquet); they are
    exact because the previous page never comes from another day.
    """
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    if since is not None:
        e = e.where(F.col("ts") >= F.lit(since).cast("date").cast("timestamp_ntz"))
    if until is not None:
        e = e.where(F.col("ts") < F.lit(until).cast("date").cast("timestamp_ntz"))
    e = chunked_previous(e.withColumn("day", F.to_date("ts")), ["user_id", "day"],
                         ["ts", "event_id"], "event_type", "last_page_id",
                         F.date_trunc("minute", "ts"))
    k = _k()
    uid = F.col("user_id")
    if province:
        c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
        e = e.join(c, e.user_id == c.c_custkey, "left")
    return e.select(
        *([F.col("c_nationkey").alias("province_id")] if province else []),
        F.concat(F.lit("b"), (uid % 4).cast("string")).alias("brand"),
        F.concat(F.lit("ch"), (k % 5).cast("string")).alias("channel"),
        F.when(uid % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("m"), (uid % 7).cast("string")).alias("model"),
        uid.cast("string").alias("mid"),
        F.when(uid % 3 == 0, "ios").otherwise("android").alias("operate_system"),
        uid.cast("string").alias("user_id"),
        F.concat(F.lit("v"), (uid % 3).cast("string")).alias("version_code"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        k.cast("string").alias("page_item"),
        F.lit("sku_id").alias("page_item_type"),
        "last_page_id",
        F.col("event_type").alias("page_id"),
        F.when(k % 2 == 0, "promotion").otherwise("query").alias("sourceType"),
        epoch_millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def raw_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS log records as JSON text (``value``) plus ``seq``, as their topic holds them:
    built once per application and input, so that routes begin at the text.

    err when page_id = 'error'; start when 'signup'; k % 3 actions; k % 4 displays.
    """
    path = stored_once(spark, "raw-log", sf_dir, lambda to: _raw_log(spark, sf_dir).write.parquet(to))
    return spark.read.schema("value string, seq bigint").parquet(path)


def _raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = page_log(spark, sf_dir)
    k = F.col("page_item").cast("int")
    n_act = k % 3
    n_dis = k % 4
    common = F.struct(
        F.col("province_id").cast("string").alias("ar"), F.col("brand").alias("ba"),
        F.col("channel").alias("ch"), "is_new", F.col("model").alias("md"), "mid",
        F.col("operate_system").alias("os"), F.col("user_id").alias("uid"),
        F.col("version_code").alias("vc"))
    page = F.struct(
        "during_time", F.col("page_item").alias("item"), F.col("page_item_type").alias("item_type"),
        "last_page_id", "page_id", F.col("sourceType").alias("source_type"))
    actions = F.transform(F.array_repeat(F.lit(0), n_act), lambda x, i: F.struct(
        F.concat(F.lit("act"), i.cast("string")).alias("action_id"),
        F.col("page_item").alias("item"),
        F.lit("sku_id").alias("item_type"),
        (F.col("ts") + (i + 1) * 1000).alias("ts")))
    displays = F.transform(F.array_repeat(F.lit(0), n_dis), lambda x, i: F.struct(
        F.lit("promotion").alias("display_type"),
        (k + i).cast("string").alias("item"),
        F.lit("sku_id").alias("item_type"),
        (i + 1).cast("string").alias("order"),
        (i % 3 + 1).cast("string").alias("pos_id")))
    start = F.struct(
        F.lit("icon").alias("entry"), F.col("during_time").alias("loading_time"),
        k.cast("string").alias("open_ad_id"), (k * 10).cast("bigint").alias("open_ad_ms"),
        F.lit(0).cast("bigint").alias("open_ad_skip_ms"))
    err = F.struct(k.alias("error_code"), F.lit("boom").alias("msg"))
    rec = F.struct(
        common.alias("common"),
        page.alias("page"),
        F.when(n_act > 0, actions).alias("actions"),
        F.when(n_dis > 0, displays).alias("displays"),
        F.when(F.col("page_id") == "signup", start).alias("start"),
        F.when(F.col("page_id") == "error", err).alias("err"),
        F.col("ts").alias("ts"))
    return p.select(F.to_json(rec).alias("value"), "seq")


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_info dimension: id, gender, birthday (date)."""
    c = table(spark, sf_dir, "customer", "c_custkey")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.date_add(F.lit("1950-01-01").cast("date"),
                   (F.col("c_custkey") * 37 % 18000).cast("int")).alias("birthday"))


def base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """base_province dimension: id, name, area_code, iso_code, iso_3166_2."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    return n.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.col("n_nationkey").cast("string").alias("iso_code"),
        F.concat(F.lit("CN-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso_3166_2"))


def _order_create_time(later: F.Column | int = 0) -> F.Column:
    """Order date plus seconds by key; ``later`` more seconds for an order's lines."""
    return F.date_format(
        F.timestamp_add("SECOND", F.col("o_orderkey") % 80000 + later, F.col("o_orderdate")),
        "yyyy-MM-dd HH:mm:ss")


def _since(orders: DataFrame, since: str | None) -> DataFrame:
    """Orders from a day on; the bound reaches the scan."""
    if since is None:
        return orders
    return orders.where(F.col("o_orderdate") >= F.lit(since).cast("date").cast("timestamp_ntz"))


#: One pass of several over the orders: its number and how many there are.
Pass = tuple[int, int]


def _of_pass(rows: DataFrame, key: str, part: Pass | None) -> DataFrame:
    """The rows of one pass by their order's key."""
    return rows if part is None or part[1] == 1 else rows.where(in_pass(key, *part))


def order_passes(spark: SparkSession, sf_dir: str) -> list[Pass]:
    """The passes in which tables of all orders and lines are written."""
    n = passes(spark, *[f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("orders", "lineitem")])
    return [(k, n) for k in range(n)]


def order_info(spark: SparkSession, sf_dir: str, since: str | None = None,
               part: Pass | None = None) -> DataFrame:
    """ODS order_info rows (before enrichment), of the days from ``since`` on; of one pass if
    ``part`` is given."""
    o = _since(_of_pass(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                              "o_totalprice", "o_orderdate"), "o_orderkey", part), since)
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"),
        F.lit(None).cast("decimal(18,2)").alias("activity_reduce_amount"),
        F.lit(None).cast("decimal(18,2)").alias("coupon_reduce_amount"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("original_total_amount"),
        F.lit(None).cast("decimal(18,2)").alias("feight_fee"),
        F.lit(None).cast("decimal(18,2)").alias("feight_fee_reduce"),
        _order_create_time().alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
        F.lit(None).cast("string").alias("expire_time"),
        F.lit(None).cast("string").alias("refundable_time"),
    )


DETAIL_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def order_lines(spark: SparkSession, sf_dir: str, since: str | None = None,
                part: Pass | None = None) -> DataFrame:
    """lineitem joined with its order (create_time, a minute later per line).
    id = l_orderkey*1000 + line rank within the order. ``part`` as in ``order_info``."""
    li = _of_pass(table(spark, sf_dir, "lineitem", "l_orderkey", *DETAIL_ORDER), "l_orderkey", part)
    o = _since(_of_pass(table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate"), "o_orderkey", part), since)
    w = Window.partitionBy("l_orderkey").orderBy(*DETAIL_ORDER)
    ranked = li.withColumn("rn", F.row_number().over(w))
    j = ranked.join(o, ranked.l_orderkey == o.o_orderkey, "inner")
    amount = F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                     * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2)
    return j.select(
        (F.col("l_orderkey") * 1000 + F.col("rn")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        _order_create_time(F.col("rn") * 60).alias("create_time"),
        amount.cast("decimal(18,2)").alias("split_total_amount"),
        F.lit(0).cast("decimal(18,2)").alias("split_activity_amount"),
        F.lit(0).cast("decimal(18,2)").alias("split_coupon_amount"),
    )


def with_part(spark: SparkSession, sf_dir: str, lines: DataFrame, sku: bool = False) -> DataFrame:
    """``lines`` with their part's name and price; ``sku`` adds its brand and category."""
    more = {"p_brand": "tm_name", "p_type": "category_name"} if sku else {}
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_retailprice", *more)
    p = p.select("p_partkey", F.col("p_retailprice").cast("decimal(18,2)").alias("order_price"),
                 F.col("p_name").alias("sku_name"),
                 *[F.col(c).alias(name) for c, name in more.items()])
    return lines.join(p, lines.sku_id == p.p_partkey, "left").drop("p_partkey")


def order_detail(spark: SparkSession, sf_dir: str, since: str | None = None,
                 sku: bool = False, part: Pass | None = None) -> DataFrame:
    """ODS order_detail rows: order lines with part (name, price). ``sku`` adds the part's
    brand and category; ``part`` as in ``order_info``."""
    more = ["tm_name", "category_name"] if sku else []
    return with_part(spark, sf_dir, order_lines(spark, sf_dir, since, part), sku).select(
        "id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "create_time",
        "split_total_amount", "split_activity_amount", "split_coupon_amount", *more)


def part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sku dimension for brand/category reports: sku_id, brand, category."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    return p.select(F.col("p_partkey").alias("sku_id"), F.col("p_brand").alias("tm_name"),
                    F.col("p_type").alias("category_name"))


def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records (table, type, data JSON, seq) from orders.

    type cycles by o_orderkey % 6, table by o_custkey % 3 (so all changes of one
    customer land in one table); data.id is the order key, the customer key, or
    customer key % 25 (province) per table.
    """
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_totalprice", "o_orderpriority")
    types = F.array(*[F.lit(t) for t in CDC_TYPES])
    tables = F.array(*[F.lit(t) for t in CDC_TABLES])
    tname = F.element_at(tables, (F.col("o_custkey") % 3 + 1).cast("int"))
    rid = (F.when(tname == "order_info", F.col("o_orderkey").cast("string"))
           .when(tname == "user_info", F.concat(F.lit("u-"), F.col("o_custkey").cast("string")))
           .otherwise((F.col("o_custkey") % 25).cast("string")))
    data = F.struct(rid.alias("id"), F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("amount"),
                    F.col("o_orderpriority").alias("priority"))
    return o.select(
        tname.alias("table"),
        F.element_at(types, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("type"),
        F.to_json(data).alias("data"),
        F.col("o_orderkey").alias("seq"))


def shaped_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of three tables that share no member but the id, from orders; type and
    table cycle as in ``cdc_records``. Every 11th text is cut, every 13th amount is none."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    amount = F.when(key % 13 == 0, F.lit('"12x"')).otherwise(F.col("o_totalprice").cast("string"))
    data = (F.when(cust % 3 == 0, F.concat(F.lit('{"id":'), key, F.lit(',"total_amount":'), amount,
                                           F.lit(',"lines":[{"no":1},{"no":"b"}]}')))
            .when(cust % 3 == 1, F.concat(F.lit('{"id":"u-'), cust, F.lit('","gender":"'),
                                          F.when(cust % 2 == 0, "M").otherwise("F"), F.lit('"}')))
            .otherwise(F.concat(F.lit('{"id":'), cust % 25, F.lit(',"geo":{"area":'), cust % 7, F.lit("}}"))))
    data = F.when(key % 11 == 0, F.substring(data, F.lit(1), F.length(data) - 2)).otherwise(data)
    names, types = (F.array(*[F.lit(t) for t in values]) for values in (CDC_TABLES, CDC_TYPES))
    return o.select(F.element_at(names, (cust % 3 + 1).cast("int")).alias("table"),
                    F.element_at(types, (key % 6 + 1).cast("int")).alias("type"),
                    data.alias("data"), key.alias("seq"))


def table_config(spark: SparkSession, fact=FACT_TABLES, dim=DIM_TABLES) -> DataFrame:
    """Routing configuration (S3): (table_name, role). A small, editable table."""
    rows = [(t, "fact") for t in fact] + [(t, "dim") for t in dim]
    return spark.createDataFrame(rows, "table_name string, role string")
