"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def route_name(prefix: str, table, op=None, sep: str = "_") -> Column:
    """E.g. DWD_{UPPER(table)}_{op} or DIM:{UPPER(table)}:{id}."""
    parts = [F.lit(prefix), F.upper(_c(table))]
    if op is not None:
        parts.append(_c(op))
    return F.concat_ws(sep, *parts)


def zip_map(keys, values) -> Column:
    """Two arrays -> map."""
    return F.map_from_arrays(_c(keys), _c(values))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """X11: null -> default per named column (numeric zero defaults of the beans)."""
    return df.fillna(defaults)


def copy_fields(src: DataFrame, target_columns: list[str], **overrides: Column) -> DataFrame:
    """Fill a target record layout from a source by same-named fields.
    Target fields missing in the source are null (unless overridden)."""
    have = set(src.columns)
    cols = []
    for name in target_columns:
        if name in overrides:
            cols.append(overrides[name].alias(name))
        elif name in have:
            cols.append(F.col(name))
        else:
            cols.append(F.lit(None).alias(name))
    return src.select(*cols)


def include_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Include-list projection."""
    return df.select(*fields)


def exclude_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Exclude-list projection."""
    return df.drop(*fields)
