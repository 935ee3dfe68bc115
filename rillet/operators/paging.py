"""Sorted pages (L1, L2; top-k is a first page). Every ordering ends with a unique tie-breaker so
pages are stable; a page is a TakeOrdered (per-partition top n, then merge)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rillet.session import no_shuffle_left


def page(df: DataFrame, order: list, page_no: int = 1, page_size: int = 20) -> DataFrame:
    """L2: skip (page_no-1)*page_size rows of the ordering, take page_size."""
    start = max(page_no - 1, 0) * page_size
    return df.orderBy(*order).offset(start).limit(page_size)


def write_ordered(df: DataFrame, order: list, path: str, ranges: int | None = None) -> None:
    """An ordered copy of ``df``: a folder per range of the ordering, so that a deep page
    need not pass over the rows before it. ``order`` ends with a unique column. Bounds of
    the ranges come from a sample; no task sorts more than its range. The shuffle files go
    when the copy is written."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with no_shuffle_left(df.sparkSession):
        (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("__range", F.spark_partition_id())
         .write.option("compression", "zstd").partitionBy("__range").parquet(path))


class Ordered:
    """Pages of an ordered copy of rows of ``schema``. The rows of each range are counted once, from the files'
    footers: one number a range comes to the driver."""

    def __init__(self, spark: SparkSession, path: str, order: list, schema: StructType):
        self.rows = spark.read.schema(StructType([*schema, StructField("__range", IntegerType())])).parquet(path)
        self.order = order
        counts = self.rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range")
        self.counts = [(r["__range"], r["n"]) for r in counts.collect()]
        self.total = sum(n for _, n in self.counts)

    def page(self, page_no: int = 1, page_size: int = 20) -> DataFrame:
        """L2: rows (page_no-1)*page_size on, page_size of them: the ranges that hold them
        are read, and only what stands before them in their first range is passed over."""
        start = max(page_no - 1, 0) * page_size
        before, wanted, skip = 0, [], 0
        for number, n in self.counts:
            if before + n > start and before < start + page_size:
                skip = start - before if not wanted else skip
                wanted.append(number)
            before += n
        rows = self.rows.where(F.col("__range").isin(wanted) if wanted else F.lit(False))
        return rows.orderBy(*self.order).offset(max(skip, 0)).limit(page_size).drop("__range")
