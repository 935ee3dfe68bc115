"""JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(value, schema: StructType | str) -> Column:
    """JSON string -> struct. Malformed text gives a null struct
    (PERMISSIVE), which callers route to a quarantine output."""
    return F.from_json(_c(value), schema, {"mode": "PERMISSIVE"})


def to_json_record(*cols) -> Column:
    """Record -> JSON string; null members are omitted."""
    if not cols:
        return F.to_json(F.struct(F.col("*")))
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def member(value, path: str, cast: str | None = None) -> Column:
    """One JSON member by path, e.g. '$.body.client'; optional cast (null if the
    member is not of that type)."""
    out = F.get_json_object(_c(value), path)
    return out.try_cast(cast) if cast else out


def array_length(value, path: str = "$") -> Column:
    """Length of a JSON array member."""
    return F.json_array_length(F.get_json_object(_c(value), path))
