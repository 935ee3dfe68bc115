"""Routing of raw records into detail tables.

Log records: parse JSON once (P1/P2), then every route is a filter + projection
(+ explode) over the same parsed frame, so one micro-batch feeds all outputs.
Change records: op mapping, then semi joins with the routing config.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.json import parse
from rillet.functions.misc import route_name
from rillet.operators.dedup import last_per_key
from rillet.operators.joins import semi_by_config
from rillet.schemas import (ACTION_LOG_FIELDS, DISPLAY_LOG_FIELDS, PAGE_LOG_FIELDS, RAW_LOG,
                            START_LOG_FIELDS)

REC = "__rec"


BAD = "__bad"
#: The members that are no text, read as text.
_AS_TEXT = ("ts string, page struct<during_time:string>, start struct<loading_time:string,"
            "open_ad_ms:string,open_ad_skip_ms:string>, actions array<struct<ts:string>>")
_TYPED = ("ts", "page.during_time", "start.loading_time", "start.open_ad_ms", "start.open_ad_skip_ms")


def parse_log(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw JSON text -> struct column ``__rec`` (other columns kept), and ``__bad``:
    why the record cannot be routed; null if it can. It may be no JSON, hold a member that
    is not of its type, or have no ts."""
    parsed = raw.withColumn(REC, parse(value_col, RAW_LOG)).withColumn("__text", parse(value_col, _AS_TEXT))
    bad = F.lit(None).cast("string")
    for member in reversed(_TYPED):
        there = F.col(f"__text.{member}").isNotNull() & F.col(f"{REC}.{member}").isNull()
        bad = F.when(there, member).otherwise(bad)
    times = [F.coalesce(F.size(F.filter(F.col(f"{c}.actions.ts"), lambda t: t.isNotNull())), F.lit(0))
             for c in ("__text", REC)]
    bad = F.concat(F.lit("no number: "), F.coalesce(bad, F.when(times[0] > times[1], "actions.ts")))
    untimed = F.col(f"{REC}.ts").isNull()  # the text is parsed once more only for these
    fault = (F.when(untimed & F.try_parse_json(value_col).isNull(), "no json").when(bad.isNotNull(), bad)
             .when(untimed, "no ts"))
    return parsed.withColumn(BAD, fault).drop("__text")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Records that are malformed, have a member of the wrong type or no ts (the reference
    fails the task)."""
    return parsed.where(F.col(BAD).isNotNull())


def _valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD).isNull())


def _device(r: str = REC) -> dict:
    """The common block, renamed."""
    return {
        "province_id": F.col(f"{r}.common.ar"), "brand": F.col(f"{r}.common.ba"),
        "channel": F.col(f"{r}.common.ch"), "is_new": F.col(f"{r}.common.is_new"),
        "model": F.col(f"{r}.common.md"), "mid": F.col(f"{r}.common.mid"),
        "operate_system": F.col(f"{r}.common.os"), "user_id": F.col(f"{r}.common.uid"),
        "version_code": F.col(f"{r}.common.vc"),
    }


def _page(r: str = REC) -> dict:
    return {
        "during_time": F.col(f"{r}.page.during_time"), "page_item": F.col(f"{r}.page.item"),
        "page_item_type": F.col(f"{r}.page.item_type"),
        "last_page_id": F.col(f"{r}.page.last_page_id"), "page_id": F.col(f"{r}.page.page_id"),
        "sourceType": F.col(f"{r}.page.source_type"), "ts": F.col(f"{r}.ts"),
    }


def _no_err() -> F.Column:
    return F.col(f"{REC}.err").isNull()


def _has_page() -> F.Column:
    return _no_err() & F.col(f"{REC}.page").isNotNull()


def error_route(parsed: DataFrame) -> DataFrame:
    """A record with err emits only its err object (raw JSON)."""
    return _valid(parsed).where(~_no_err()).select(F.col(f"{REC}.err").alias("err"))


def page_route(parsed: DataFrame) -> DataFrame:
    """P5: page present -> PageLog."""
    m = {**_device(), **_page()}
    return _valid(parsed).where(_has_page()).select(*[m[f].alias(f) for f in PAGE_LOG_FIELDS])


def action_route(parsed: DataFrame) -> DataFrame:
    """Explode actions; rows inherit the page fields, keep action ts and page ts."""
    x = _valid(parsed).where(_has_page()).select("*", F.explode(f"{REC}.actions").alias("__a"))
    m = {**_device(), **_page(), "action_id": F.col("__a.action_id"),
         "action_item": F.col("__a.item"), "action_item_type": F.col("__a.item_type"),
         "action_ts": F.col("__a.ts")}
    return x.select(*[m[f].alias(f) for f in ACTION_LOG_FIELDS])


def display_route(parsed: DataFrame, compat: bool = False) -> DataFrame:
    """Explode displays. ``compat=True`` reproduces the reference's nesting of
    the display loop inside the action loop (each display once per action)."""
    x = _valid(parsed).where(_has_page())
    if compat:
        x = x.select("*", F.explode(f"{REC}.actions").alias("__a"))
    x = x.select("*", F.explode(f"{REC}.displays").alias("__d"))
    m = {**_device(), **_page(), "displayType": F.col("__d.display_type"),
         "display_item": F.col("__d.item"), "display_item_type": F.col("__d.item_type"),
         "order": F.col("__d.order"), "pos_id": F.col("__d.pos_id")}
    return x.select(*[m[f].alias(f) for f in DISPLAY_LOG_FIELDS])


def start_route(parsed: DataFrame) -> DataFrame:
    """Start present -> StartLog (independent of the page route)."""
    x = _valid(parsed).where(_no_err() & F.col(f"{REC}.start").isNotNull())
    s = f"{REC}.start"
    m = {**_device(), "entry": F.col(f"{s}.entry"), "loading_time": F.col(f"{s}.loading_time"),
         "open_ad_id": F.col(f"{s}.open_ad_id"), "open_ad_ms": F.col(f"{s}.open_ad_ms"),
         "open_ad_skip_ms": F.col(f"{s}.open_ad_skip_ms"), "ts": F.col(f"{REC}.ts")}
    return x.select(*[m[f].alias(f) for f in START_LOG_FIELDS])


def _n(arr: str) -> F.Column:
    c = F.col(arr)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def route_counts(parsed: DataFrame) -> DataFrame:
    """Rows each route would emit, from one aggregate pass over the parsed batch."""
    v = _valid(parsed)
    page = _has_page()
    agg = v.agg(
        F.count_if(~_no_err()).alias("error"),
        F.count_if(page).alias("page"),
        F.sum(F.when(page, _n(f"{REC}.actions")).otherwise(0)).cast("bigint").alias("action"),
        F.sum(F.when(page, _n(f"{REC}.displays")).otherwise(0)).cast("bigint").alias("display"),
        F.sum(F.when(page, _n(f"{REC}.actions") * _n(f"{REC}.displays")).otherwise(0))
        .cast("bigint").alias("display_compat"),
        F.count_if(_no_err() & F.col(f"{REC}.start").isNotNull()).alias("start"))
    return agg.select(F.expr(
        "stack(6, 'error', error, 'page', page, 'action', action, 'display', display, "
        "'display_compat', display_compat, 'start', start) as (route, rows)"))


# ---- change records -------------------------------------------------------

# Change type -> operation letter; other types are dropped.
CDC_OP = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}

# An id may be a number or text; as a string either keeps its own key.
CDC_DATA_SCHEMA = "id string, status string, amount double, priority string"


def change_op(kind: str) -> F.Column:
    """The operation letter of a change type; null for other types."""
    op = F.lit(None).cast("string")
    for t, letter in reversed(list(CDC_OP.items())):
        op = F.when(F.col(kind) == t, letter).otherwise(op)
    return op


def cdc_ops(records: DataFrame, data_schema: str = CDC_DATA_SCHEMA) -> DataFrame:
    """Map the change type to I/U/D, drop anything else; parse data JSON."""
    return (records.withColumn("op", change_op("type")).where(F.col("op").isNotNull())
            .withColumn("rec", F.from_json("data", data_schema)))


def fact_route(ops: DataFrame, config: DataFrame) -> DataFrame:
    """P10 + J6 + X6: fact tables -> (topic DWD_{TABLE}_{op}, key data.id, value data)."""
    f = semi_by_config(ops, config, "fact")
    return f.select(route_name("DWD", "table", "op").alias("topic"),
                    F.col("rec.id").cast("string").alias("key"),
                    F.col("data").alias("value"), "seq")


def dim_route(ops: DataFrame, config: DataFrame, compat: bool = False) -> DataFrame:
    """P11 + K3: dimension tables -> latest row per (table, id) by seq.

    Default: a delete as the latest change removes the key (tombstone).
    ``compat=True`` keeps the deleted row as its value, as the reference does.
    """
    d = semi_by_config(ops, config, "dim").select(
        "table", F.col("rec.id").alias("id"), "op", "seq", "data", "rec")
    last = last_per_key(d, ["table", "id"], ["seq"])
    if not compat:
        last = last.where(F.col("op") != "D")
    return last.select(
        F.concat(F.lit("DIM:"), F.upper("table"), F.lit(":"), F.col("id").cast("string"))
        .alias("dim_key"), "table", "id", "op", "seq", "data", "rec")
