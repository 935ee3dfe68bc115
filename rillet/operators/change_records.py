"""Change records whose fields differ by table and are not known beforehand.

``data`` is parsed to a VARIANT, so that a member of any shape travels whole and is read by
path where it is asked for. What a job does ask of a member's type is declared per table; a
row whose text does not parse, that has no id, or whose declared member does not have its
type goes to quarantine with the reason, and nowhere else. Other types than insert, update
and delete are dropped as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.misc import route_name
from rillet.operators.dedup import last_per_key
from rillet.operators.joins import semi_by_config
from rillet.operators.routing import change_op

#: Types that a table's members must have: table -> {path: type}.
MemberTypes = dict[str, dict[str, str]]


def read_member(path: str, kind: str = "string", record: str = "rec") -> Column:
    """One member by path; null if it is not there or not of this type."""
    return F.try_variant_get(record, path, kind)


def parse_changes(records: DataFrame, types: MemberTypes | None = None) -> DataFrame:
    """``records(table, type, data, seq)`` with ``op``, ``rec`` (VARIANT), ``id`` (text) and
    ``fault``: why the row cannot be routed, null if it can."""
    rows = records.withColumn("op", change_op("type")).where(F.col("op").isNotNull())
    rows = rows.withColumn("rec", F.try_parse_json("data"))
    rows = rows.withColumn("id", read_member("$.id"))
    fault = F.when(F.col("rec").isNull(), "no json").when(F.col("id").isNull(), "no id")
    for name, members in (types or {}).items():
        for path, kind in members.items():
            there = read_member(path).isNotNull() & read_member(path, kind).isNull()
            fault = fault.when((F.col("table") == name) & there, f"no {kind}: {path}")
    return rows.withColumn("fault", fault)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that go nowhere else, with their text and why."""
    return parsed.where(F.col("fault").isNotNull()).select("table", "type", "seq", "data", "fault")


def fact_rows(parsed: DataFrame, config: DataFrame) -> DataFrame:
    """P10: rows of fact tables as (topic, key, value, seq) with the record."""
    good = semi_by_config(parsed.where(F.col("fault").isNull()), config, "fact")
    return good.select(route_name("DWD", "table", "op").alias("topic"), F.col("id").alias("key"),
                       F.col("data").alias("value"), "seq", "rec")


def dim_rows(parsed: DataFrame, config: DataFrame) -> DataFrame:
    """The latest row of each (table, id) of dimension tables, deleted ones hidden. The
    text travels, since a VARIANT cannot be compared or shuffled by value; it is parsed
    again where members are read."""
    good = semi_by_config(parsed.where(F.col("fault").isNull()), config, "dim")
    last = last_per_key(good.select("table", "id", "op", "seq", "data"), ["table", "id"], ["seq"])
    key = F.concat(F.lit("DIM:"), F.upper("table"), F.lit(":"), F.col("id"))
    return last.where(F.col("op") != "D").select(key.alias("dim_key"), "table", "id", "seq", "data",
                                                 F.try_parse_json("data").alias("rec"))
