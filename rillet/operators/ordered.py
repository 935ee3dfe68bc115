"""Ordered operations within a group, split into time chunks so that one hot
group never becomes one sorted task.

A window ``partitionBy(group).orderBy(time)`` sends a whole group to one task.
When one device holds a third of all rows, that task holds a third of the data.
Here the window runs per (group, chunk), where the chunk is a time slice
(a minute by default). A summary with one row per (group, chunk), which is a
map-side combined aggregate, carries what a chunk needs from the chunks before
it: the number of flagged rows before it, for a running count, or the last value before
it, for the value of the previous row.
It is bounded by the number of chunks per group (1,440 minutes in a day-scoped
group). Each carry enters its chunk's window as one extra leading row, so the
data is shuffled once, on (group, chunk), and null group keys behave as they
do in a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "__chunk"
_DATA = "__data"  # 0 = carry row (sorts first in its chunk), 1 = data row


def _with_carry(x: DataFrame, carry: DataFrame) -> DataFrame:
    return (x.withColumn(_DATA, F.lit(1))
             .unionByName(carry.withColumn(_DATA, F.lit(0)), allowMissingColumns=True))


def chunked_running_count(df: DataFrame, group: Sequence[str], order: Sequence[str],
                          flag: Column, out: str, chunk: Column) -> DataFrame:
    """``out`` = number of rows with ``flag`` true from the group's first row up
    to this one, in ``order``; equals ``sum(flag) over (partition by group
    order by order rows unbounded preceding)``."""
    group, order = list(group), list(order)
    x = df.withColumn(_CHUNK, chunk).withColumn("__f", flag.cast("bigint"))
    summary = x.groupBy(*group, _CHUNK).agg(F.sum("__f").alias("__n"))
    w_ch = (Window.partitionBy(*group).orderBy(_CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1))
    carry = summary.select(*group, _CHUNK,
                           F.coalesce(F.sum("__n").over(w_ch), F.lit(0)).alias("__f"))
    w_in = (Window.partitionBy(*group, _CHUNK).orderBy(_DATA, *order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (_with_carry(x, carry)
            .withColumn(out, F.sum("__f").over(w_in))
            .where(F.col(_DATA) == 1)
            .drop("__f", _DATA, _CHUNK))


def chunked_previous(df: DataFrame, group: Sequence[str], order: Sequence[str],
                     value: str, out: str, chunk: Column) -> DataFrame:
    """``out`` = ``value`` of the group's previous row in ``order``, null at its first;
    equals ``lag(value) over (partition by group order by order)``."""
    group, order = list(group), list(order)
    x = df.withColumn(_CHUNK, chunk)
    last = x.groupBy(*group, _CHUNK).agg(
        F.max_by(F.struct(value), F.struct(*order)).alias("__last"))
    w_ch = Window.partitionBy(*group).orderBy(_CHUNK)
    carry = last.select(*group, _CHUNK, F.lag("__last").over(w_ch)[value].alias(value))
    w_in = Window.partitionBy(*group, _CHUNK).orderBy(_DATA, *order)
    return (_with_carry(x, carry)
            .withColumn(out, F.lag(value).over(w_in))
            .where(F.col(_DATA) == 1)
            .drop(_DATA, _CHUNK))
