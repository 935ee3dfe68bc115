"""Predicates (F1-F4) as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def term(field: str, value) -> Column:
    """exact term."""
    return F.col(field) == F.lit(value)


def range_(field: str, gte=None, lte=None, gt=None, lt=None) -> Column:
    """closed / half-open range; unset bounds are open."""
    c = F.col(field)
    conds = []
    if gte is not None:
        conds.append(c >= F.lit(gte))
    if gt is not None:
        conds.append(c > F.lit(gt))
    if lte is not None:
        conds.append(c <= F.lit(lte))
    if lt is not None:
        conds.append(c < F.lit(lt))
    return reduce(lambda a, b: a & b, conds, c.isNotNull())


def bool_query(must: list[Column] = (), filter: list[Column] = (),  # noqa: A002
               must_not: list[Column] = (), should: list[Column] = (),
               minimum_should_match: int | None = None) -> Column:
    """must AND filter AND NOT any(must_not). ``should`` only ranks when a
    must/filter clause exists; with none of them, at least one should must hold
    (or ``minimum_should_match``). Null predicates count as false."""
    def t(c):
        return F.coalesce(c, F.lit(False))
    out = F.lit(True)
    for c in list(must) + list(filter):
        out = out & t(c)
    for c in must_not:
        out = out & ~t(c)
    should = list(should)
    msm = minimum_should_match
    if msm is None and should and not (list(must) or list(filter)):
        msm = 1
    if should and msm:
        hits = reduce(lambda a, b: a + b, [t(c).cast("int") for c in should])
        out = out & (hits >= msm)
    return out
