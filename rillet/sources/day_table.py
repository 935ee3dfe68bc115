"""Keyed, day-partitioned Parquet tables with idempotent upserts (K4, K5, K7, S4-S7), by
plain Spark writes.

An upsert writes its rows, and nothing else, to a folder of its batch, partitioned by the
table's partition columns; a batch that is delivered again writes the same folder again. A
read takes the latest row of each (partition, key): by ``seq`` if the table has one, then by
the time of the write. Compaction brings the batches into the day folders by Spark's dynamic
partition overwrite of the days they touch, then empties the batches; in between, a row may
stand in both places and is read once. A delete overwrites the days it touches, with the
deleted rows marked, so that an older version of a row does not come back. A written folder
holds a (partition, key) once, so a read merges only the partitions that stand in several.

A table whose partition values grow with its rows has ``folders``, a fixed number of them, by
hash of these values; the values stand in the files. What is listed, committed and sent to
the driver then grows no more with the number of values.

One writer at a time; a row is seen as soon as its batch's folder is there.
"""

from __future__ import annotations

import re
import time
import uuid
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, LongType, StringType, StructField, StructType)

from rillet.operators.dedup import last_per_key
from rillet.session import no_shuffle_left

#: Batches that wait before an upsert compacts them.
COMPACT = 16
#: Rows that one step of a compaction moves, and partitions that are named in a condition.
STEP_ROWS, NAMED = 1 << 22, 200
_WRITE, _GONE, _BATCH, _FOLDER = "__write", "__gone", "__batch", "__folder"


class DayTable:
    def __init__(self, spark: SparkSession, path: str, key: list[str],
                 partition_by: list[str], seq: str | None = None,
                 schema: StructType | None = None, partition_types: dict | None = None,
                 compact: int = COMPACT, folders: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.days, self.batches = f"{self.path}/days", f"{self.path}/batches"
        # partition values are typed by declaration (default string), not inferred
        self.partition_types = {c: "string" for c in partition_by} | (partition_types or {})
        self.key, self.partition_by, self.seq = list(key), list(partition_by), seq
        self.identity = list(dict.fromkeys([*self.partition_by, *self.key]))
        self.schema, self.compact_at = schema, compact
        self.folders, self.layout = folders, [_FOLDER] if folders else self.partition_by

    # ---- reads ---------------------------------------------------------------
    def _inferred(self) -> StructType | None:
        """The schema that the files have; None if nothing was written."""
        for root in (self.batches, self.days):
            try:
                fields = self.spark.read.parquet(root).schema.fields
            except AnalysisException as error:
                if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    continue
                raise
            typed = self.spark.createDataFrame([], ", ".join(
                f"`{c}` {t}" for c, t in self.partition_types.items())).schema
            own = [f for f in fields if f.name not in (_WRITE, _GONE, _BATCH, _FOLDER)]
            return StructType([typed[f.name] if f.name in self.partition_types else f for f in own])
        return None

    def _known(self) -> StructType | None:
        if self.schema is None:
            self.schema = self._inferred()
        return self.schema

    def _rows(self, root: str, batch: bool = False) -> DataFrame:
        """Rows below ``root`` with the time of their write and the mark of a delete; ``batch``
        adds the name of the waiting batch, none in the days."""
        full = StructType([*self._known().fields, StructField(_WRITE, LongType()),
                           StructField(_GONE, BooleanType()),
                           *([StructField(_FOLDER, LongType())] if self.folders else [])])
        named = StructType([*full.fields, StructField(_BATCH, StringType())])
        try:
            rows = self.spark.read.schema(full if root == self.days else named).parquet(root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], full)
        if batch and _BATCH not in rows.columns:
            rows = rows.withColumn(_BATCH, F.lit(None).cast("string"))
        return rows.select(*full.names, *([_BATCH] if batch else []))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with what their folder is named by."""
        if not self.folders or _FOLDER in rows.columns:
            return rows
        return rows.withColumn(_FOLDER, F.pmod(F.xxhash64(*self.partition_by), F.lit(self.folders)))

    def _latest(self, rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
        return last_per_key(rows, keys or self.identity, [*([self.seq] if self.seq else []), _WRITE])

    def _in(self, parts: list) -> Column:
        """Rows of the partitions ``parts``; never null."""
        return reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(F.lit(p[c])) for c in self.layout]) for p in parts],
                      F.lit(False))

    def _merged(self) -> DataFrame:
        """The latest rows of days and waiting batches. Only partitions that stand in several of
        them are merged; each of the others holds a key once."""
        rows = self._rows(self.days).unionByName(self._rows(self.batches))
        places = self._rows(self.days, True).unionByName(self._rows(self.batches, True))
        places = places.select(*self.layout, _BATCH).distinct().groupBy(*self.layout)
        with no_shuffle_left(self.spark):
            shared = places.agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(NAMED + 1).collect()
        if len(shared) > NAMED:
            return self._latest(rows)
        if not shared:
            return rows
        return rows.where(~self._in(shared)).unionByName(self._latest(rows.where(self._in(shared))))

    def _waiting(self) -> set[str]:
        """Folders of batches that are not in the days yet."""
        files = self._rows(self.batches).inputFiles()
        return {m[1] for f in files if (m := re.search(f"/{_BATCH}=([^/]+)/", f))}

    def exists(self) -> bool:
        return self._inferred() is not None

    def read(self) -> DataFrame:
        """Every row. A table never written reads as empty (needs a schema)."""
        if self._known() is None:
            raise ValueError(f"{self.path} was never written and has no schema")
        rows = self._rows(self.days)
        if self._waiting():  # compacted days hold one row a key
            rows = self._merged()
        return rows.where(F.col(_GONE).isNull()).select(*self.schema.names)

    def read_partition(self, **values) -> DataFrame:
        """Rows of one partition (pruned at the scan); absent -> empty."""
        df = self.read()
        for k, v in values.items():
            df = df.where(F.col(k).isNull() if v is None else F.col(k) == F.lit(v))
        return df

    def get(self, **key_values) -> DataFrame:
        """Point read by key."""
        df = self.read()
        for k, v in key_values.items():
            df = df.where(F.col(k) == F.lit(v))
        return df

    def column(self, field: str, **partition_values) -> DataFrame:
        """Single-column scan (no row cap)."""
        return self.read_partition(**partition_values).select(field)

    def touched_rows(self, batch: DataFrame) -> DataFrame | None:
        """Stored rows of the partitions ``batch`` touches (None if there is no table).
        The days of the batch prune the scan when the join's build side is small."""
        if not self.exists():
            return None
        return self._of_days(self.read(), batch).select(*self.schema.names)

    def _of_days(self, rows: DataFrame, other: DataFrame) -> DataFrame:
        rows, days = self._placed(rows), self._placed(other).select(*self.layout).distinct()
        same = [rows[c].eqNullSafe(days[c]) for c in self.layout]
        return rows.join(days, same, "left_semi")

    # ---- writes ---------------------------------------------------------------
    def _write(self, rows: DataFrame, path: str, mode: str = "static", unique: bool = False) -> None:
        """Rows by ranges of (partition value, key), from a sample of the batch: a hot day
        is split over many tasks, small days share one, and files have tight key bounds. Of the
        rows of a key, which a range holds together, the latest is written."""
        rows, order = self._placed(rows), list(dict.fromkeys([*self.layout, *self.identity]))
        ranges = rows.repartitionByRange(*order)
        ranges = ranges if unique else self._latest(ranges, order)
        with no_shuffle_left(self.spark):
            (ranges.sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd")
             .option("partitionOverwriteMode", mode).partitionBy(*self.layout).parquet(path))

    def upsert(self, batch: DataFrame, name: str | None = None) -> None:
        """K4/K5: insert or replace rows by partition and key. ``name`` names the batch;
        one that is delivered again replaces itself."""
        rows = batch.select(*[F.col(c).cast(self.partition_types[c]).alias(c)
                              if c in self.partition_types else F.col(c) for c in batch.columns])
        if self._known() is None:
            self.schema = rows.schema
        rows = rows.select(*self.schema.names).withColumn(
            _WRITE, F.lit(time.time_ns())).withColumn(_GONE, F.lit(None).cast("boolean"))
        self._write(rows, f"{self.batches}/{_BATCH}={name or uuid.uuid4().hex}")
        if len(self._waiting()) >= self.compact_at:
            self.compact()

    def compact(self) -> None:
        """Bring the waiting batches into the folders of the days they touch."""
        if self._known() is None or not self._waiting():
            return
        new, days = self._rows(self.batches), self._rows(self.days)
        for parts in self._steps(new):
            some = [rows.where(self._in(parts)) for rows in (days, new)] if parts else [self._of_days(days, new), new]
            self._write(some[0].unionByName(some[1]), self.days, "dynamic")
        self._write(new.limit(0), self.batches)

    def _steps(self, new: DataFrame) -> list[list]:
        """The partitions of ``new`` in groups of about ``STEP_ROWS`` of its rows, which come from
        the files' footers; an empty group stands for all of them."""
        with no_shuffle_left(self.spark):
            sizes = new.groupBy(*self.layout).agg(F.count(F.lit(1)).alias("n")).orderBy(*self.layout).collect()
        if sum(p["n"] for p in sizes) <= STEP_ROWS:
            return [[]]
        groups, held = [[]], 0
        for p in sizes:
            if groups[-1] and (held + p["n"] > STEP_ROWS or len(groups[-1]) == NAMED):
                groups, held = [*groups, []], 0
            groups[-1].append(p)
            held += p["n"]
        return groups

    def delete_where(self, condition: Column) -> None:
        """M5/M6 on a stored table: rows for which the condition is true go; a null
        condition keeps the row. A later upsert of the key brings it back if its ``seq`` is
        not below the deleted row's."""
        if not self.exists():
            return
        self.compact()
        rows = self._rows(self.days)
        hit = F.coalesce(condition, F.lit(False))
        touched = self._of_days(rows, rows.where(hit & F.col(_GONE).isNull()))
        marked = touched.withColumn(_GONE, F.when(hit, True).otherwise(F.col(_GONE)))
        self._write(marked, self.days, "dynamic", unique=True)


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] = ()) -> None:
    """K1/K7: append a micro-batch idempotently: the batch has a folder of its own, whose
    rows come from this batch alone; a replay writes the folder again."""
    out = df.write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(f"{path}/batch_id={int(batch_id)}")


def write_keyed(df: DataFrame, path: str, batch_id: int, topic_col: str = "topic",
                key_col: str = "key", seq_col: str = "seq") -> None:
    """K2: keyed output: rows of one key stay in ``seq`` order, one folder per
    topic. Range partitioning on (topic, key, seq) keeps each key's rows in
    consecutive, ordered files, and still splits a hot key over several tasks
    (hash partitioning on the key would send it whole to one task)."""
    out = (df.repartitionByRange(topic_col, key_col, seq_col)
           .sortWithinPartitions(topic_col, key_col, seq_col))
    out.write.mode("overwrite").partitionBy(topic_col).parquet(f"{path}/batch_id={int(batch_id)}")
