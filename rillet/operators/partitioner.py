"""Explicit key -> partition routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_id_expr(key_col: str, mapping: dict[str, int], unknown: str = "error_partition"):
    """Partition id for each key. Unknown keys go to an extra error partition
    (``unknown='error_partition'``) or fail the task (``unknown='raise'``)."""
    n = max(mapping.values()) + 1
    expr = F.lit(None).cast("int")
    for k, p in mapping.items():
        expr = F.when(F.col(key_col) == F.lit(k), F.lit(p)).otherwise(expr)
    if unknown == "raise":
        fallback = F.raise_error(F.concat(F.lit("unmapped partition key: "),
                                          F.col(key_col).cast("string"))).cast("int")
    else:
        fallback = F.lit(n)
    return F.coalesce(expr, fallback), n + (0 if unknown == "raise" else 1)


def route_partition(df: DataFrame, key_col: str, mapping: dict[str, int],
                    unknown: str = "error_partition", out: str = "partition_id") -> DataFrame:
    """The partition that each row's key names, as a column. A partition is a value,
    not a task: writers split it over tasks (``spread_partitions``), so that a hot key
    does not become one task and more rows get more tasks."""
    pid, _ = partition_id_expr(key_col, mapping, unknown)
    return df.withColumn(out, pid)


def place_partitions(df: DataFrame, key_col: str, mapping: dict[str, int], by: list[str],
                     width: int = 4, unknown: str = "error_partition") -> DataFrame:
    """Rows moved to the partition that their key names. A partition is ``width`` tasks
    wide: a row goes to task ``partition * width + hash(by) % width``, so that a key with a
    third of all rows is not one task, and each task holds rows of one partition alone.
    Null keys are unknown keys."""
    pid, n = partition_id_expr(key_col, mapping, unknown)
    task = pid * width + F.pmod(F.xxhash64(*by), F.lit(width)).cast("int")
    return df.repartitionById(n * width, task)


def spread_partitions(df: DataFrame, by: list[str], partition: str = "partition_id",
                      width: int = 16) -> DataFrame:
    """Rows of one partition together, over up to ``width`` tasks by a hash of ``by``."""
    salt = F.pmod(F.xxhash64(*by), F.lit(width))
    return df.repartition(F.col(partition), salt)
