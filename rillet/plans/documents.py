"""Keyed document tables and their changes (M1-M6, K4, K6, U3), event roll-up (D6),
explicit partitioning (U1/U2) and map/JSON scalars (X9-X11) over the test tables.

User documents: one per customer (id, name, age, sex). Change bulks come from the
orders table (several changes per customer, ordered by order key = seq).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.json import array_length, member
from rillet.functions.misc import zip_map
from rillet.functions.time import epoch_millis
from rillet.operators import dedup, mutations
from rillet.operators.aggregates import GENDER_MALE_LABEL, GENDER_OTHER_LABEL
from rillet.operators.partitioner import place_partitions, route_partition
from rillet.plans.orders import order_docs, stored_wide
from rillet.session import scratch_path
from rillet.sources import adapters
from rillet.sources.day_table import DayTable
from rillet.sources.tables import table

RENAMED = "renamed"
DELETE_ONE_ID = 1
#: Folders of the stored user table: its bands of 50 ids grow with the users.
BAND_FOLDERS = 64


def user_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    u = adapters.user_info(spark, sf_dir)
    j = c.join(u, c.c_custkey == u.id, "left")
    return j.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        (F.lit(2024) - F.year("birthday")).cast("int").alias("age"),
        F.when(F.col("gender") == "M", GENDER_MALE_LABEL).otherwise(GENDER_OTHER_LABEL).alias("sex"),
        F.lit(0).cast("bigint").alias("seq"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return o.select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("name"),
        (F.col("o_orderkey") % 80).cast("int").alias("age"),
        F.when(F.col("o_orderstatus") == "F", GENDER_OTHER_LABEL)
        .otherwise(GENDER_MALE_LABEL).alias("sex"),
        F.col("o_orderkey").alias("seq"))


def upsert_last_wins(spark, sf_dir):
    return mutations.upsert(user_docs(spark, sf_dir), user_changes(spark, sf_dir), "id", "seq")


def partial_update(spark, sf_dir):
    upd = user_changes(spark, sf_dir).select("id", "sex", "seq")
    return mutations.partial_update(user_docs(spark, sf_dir), upd, "id", ["sex"], "seq")


def update_by_query(spark, sf_dir):
    docs = order_docs(stored_wide(spark, sf_dir), adapters.part_dim(spark, sf_dir))
    out = mutations.update_by_query(docs, F.col("order_status") == "O", "items", 0, "name",
                                    F.lit(RENAMED))
    return out.select("order_id", "order_status", F.size("items").alias("n_items"),
                      F.col("items")[0]["id"].alias("first_id"),
                      F.col("items")[0]["name"].alias("first_name"))


def _deleted_users(spark, sf_dir) -> DataFrame:
    """Ids ('u-7': 7) of users with a delete change record (bulk delete input)."""
    from rillet.operators import routing
    ops = routing.cdc_ops(adapters.cdc_records(spark, sf_dir))
    return ops.where((F.col("table") == "user_info") & (F.col("op") == "D")) \
        .select(F.regexp_extract("rec.id", "^u-([0-9]+)$", 1).cast("bigint").alias("id"))


def delete_by_id(spark, sf_dir):
    docs = user_docs(spark, sf_dir)
    ids = docs.where(F.col("id") == F.lit(DELETE_ONE_ID)).select("id")
    return mutations.delete_ids(docs, ids, "id")


def bulk_delete(spark, sf_dir):
    return mutations.delete_ids(user_docs(spark, sf_dir), _deleted_users(spark, sf_dir), "id")


def append_new(spark, sf_dir):
    """K6: new documents without ids (pending orders) appended under generated ids."""
    docs = user_docs(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "name", "seq")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    new = o.where(F.col("o_orderstatus") == "P").select(
        F.concat(F.lit("pending_"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderkey").alias("seq"))
    return mutations.append_with_id(docs, new, "id", ["name", "seq"])


def rollup_events(spark, sf_dir):
    """Events of users; every 17th has no user and every 7th no kind."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.select("event_id", "value", epoch_millis("ts").alias("ts"),
                    F.when(F.col("event_id") % 17 != 0, F.col("user_id")).alias("user_id"),
                    F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"))


def event_rollup(spark, sf_dir):
    e = rollup_events(spark, sf_dir)
    return dedup.event_rollup(e, "user_id", "event_type", "ts", "value", tie="event_id")


# Fixed routing keys of the explicit partitioner (key -> partition).
PARTITION_KEYS = {"cba": 0, "wnba": 1, "nba": 2}
# The same rule applied to the event types of the test data.
EVENT_PARTITIONS = {"view": 0, "click": 1, "purchase": 2}


def route_partition_ids(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "event_type")
    routed = route_partition(e, "event_type", EVENT_PARTITIONS)
    return (routed.groupBy(F.col("event_type").alias("key"), "partition_id")
            .agg(F.count(F.lit(1)).alias("n")))


def partition_placement(spark, sf_dir):
    """Where the rows of each key really are after they were sent: the partition that
    the tasks holding them belong to."""
    e = table(spark, sf_dir, "events", "event_id", "event_type")
    width = 4
    placed = place_partitions(e, "event_type", EVENT_PARTITIONS, ["event_id"], width)
    placed = placed.withColumn("task", F.spark_partition_id())
    return placed.groupBy(F.col("event_type").alias("key"), F.floor(F.col("task") / width).cast("int").alias("partition_id")) \
        .agg(F.count(F.lit(1)).alias("n"))


def scalar_map_json(spark, sf_dir):
    """Per user, zip event types with counts into a map, serialise the
    map to JSON, parse it back and flatten (compared after parsing back)."""
    e = table(spark, sf_dir, "events", "user_id", "event_type")
    per = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = per.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("event_type", "n"))).alias("kv"))
    js = maps.select("user_id", F.to_json(zip_map(F.col("kv.event_type"), F.col("kv.n")))
                     .alias("json"))
    back = js.select("user_id", F.explode(F.from_json("json", "map<string,bigint>"))
                     .alias("event_type", "n"))
    return back


def append_ids_unique(spark, sf_dir):
    """K6: contents that differ only by where a separator stands, or by a null, keep ids
    of their own, and so do equal contents under random ids."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    parts = o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "|b").otherwise("")).alias("name"),
        F.when(F.col("o_orderkey") % 2 == 1, F.lit("b")).alias("more"))
    empty = parts.select(F.lit(None).cast("string").alias("id"), "name", "more").limit(0)
    by_content = mutations.append_with_id(empty, parts, "id", ["name", "more"])
    same = o.select(F.lit("same").alias("name"), F.lit(None).cast("string").alias("more"))
    by_chance = mutations.append_with_id(empty, same, "id")
    return by_content.withColumn("how", F.lit("content")).union(
        by_chance.withColumn("how", F.lit("random"))).groupBy("how").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


def json_members(spark, sf_dir):
    """X7 + X8: members and array lengths out of raw JSON text."""
    raw = adapters.raw_log_json(spark, sf_dir)
    return raw.select(
        "seq", member("value", "$.common.mid").alias("mid"),
        member("value", "$.page.during_time", "bigint").alias("during_time"),
        F.coalesce(array_length("value", "$.actions"), F.lit(0)).alias("n_actions"),
        F.coalesce(array_length("value", "$.displays"), F.lit(0)).alias("n_displays"))


def stored_delete(spark, sf_dir):
    """M5 + M6 + K4 on a stored table: upsert the users and their changes, delete by a
    condition, and delete all rows of one partition."""
    docs = user_docs(spark, sf_dir)
    stored = DayTable(spark, scratch_path(spark, "stored-delete"), ["id"], ["band"], seq="seq",
                      folders=BAND_FOLDERS)
    band = F.floor(F.col("id") / F.lit(50)).cast("string")
    for part in (docs, user_changes(spark, sf_dir)):
        stored.upsert(part.withColumn("band", band))
    stored.delete_where(F.col("age") > 60)
    stored.delete_where(F.col("band") == "1")
    return stored.read().select("id", "name", "age", "seq")
