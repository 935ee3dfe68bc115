"""Keyed-table changes (M1-M6, K3, K4, K6, U3) as DataFrame plans.

Every change is expressed as a new version of the table:
  upsert  = (target LEFT ANTI latest-updates) UNION latest-updates
  partial = target LEFT JOIN updates, coalesce per named field (present-flag)
  delete  = target LEFT ANTI ids
These shuffle once on the key; "latest per key" is an aggregate (max_by), so a hot
key is pre-combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.operators.dedup import last_per_key


def latest(updates: DataFrame, key: str | list[str], seq: str = "seq") -> DataFrame:
    """K3/M2: within one bulk, the later row of the same key wins."""
    keys = [key] if isinstance(key, str) else list(key)
    return last_per_key(updates, keys, [seq])


def upsert(target: DataFrame, updates: DataFrame, key: str | list[str],
           seq: str | None = "seq") -> DataFrame:
    """M1/M2/K4: insert-or-replace whole rows by key (idempotent on re-run)."""
    keys = [key] if isinstance(key, str) else list(key)
    upd = latest(updates, keys, seq) if seq else updates
    upd = upd.select(*target.columns)
    return target.join(upd.select(*keys), keys, "left_anti").unionByName(upd)


def partial_update(target: DataFrame, updates: DataFrame, key: str, fields: list[str],
                   seq: str | None = "seq") -> DataFrame:
    """M3: only the named fields change on matched keys; a named field set to null
    becomes null (present-flag), unnamed fields keep their value."""
    upd = latest(updates, [key], seq) if seq else updates
    u = upd.select(F.col(key).alias("__k"), F.lit(True).alias("__hit"),
                   *[F.col(f).alias(f"__new_{f}") for f in fields])
    j = target.join(u, F.col(key) == F.col("__k"), "left")
    cols = []
    for c in target.columns:
        if c in fields:
            cols.append(F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def update_by_query(df: DataFrame, condition: Column, array_col: str, index: int,
                    field: str, value: Column) -> DataFrame:
    """Rows matching ``condition`` get array_col[index].field = value; the
    assignment is a column expression passed as a parameter."""
    def upd(x, i):
        return F.when(i == F.lit(index), x.withField(field, value)).otherwise(x)
    return df.withColumn(array_col, F.when(F.coalesce(condition, F.lit(False)),
                                           F.transform(F.col(array_col), upd))
                         .otherwise(F.col(array_col)))


def delete_ids(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """M5/M6: delete by id (one or a bulk of ids)."""
    return target.join(ids.select(F.col(key)).distinct(), key, "left_anti")


def append_with_id(target: DataFrame, new_rows: DataFrame, id_col: str,
                   content_cols: list[str] | None = None) -> DataFrame:
    """K6: append rows under a generated id. ``content_cols`` that tell all rows apart give
    the digest of their JSON form (names, quotes, escapes and explicit nulls keep different
    contents apart), the same in a re-run; without them each row gets a random id."""
    new_id = F.uuid()
    if content_cols:
        new_id = F.md5(F.to_json(F.struct(*[F.col(c) for c in content_cols]),
                                 {"ignoreNullFields": "false"}))
    return target.unionByName(new_rows.withColumn(id_col, new_id).select(*target.columns))
