"""Topics as folders of Parquet files, read as a stream by offset.

A topic is a folder ``topic=<name>/partition=<n>`` of immutable files with the columns
``offset, key, value``; offsets grow within a partition. The stream source is a Python data
source: its position is the next offset of every partition, so a query resumes exactly there
from its checkpoint, whatever files came since. A first start reads from the latest offsets,
from the earliest, or from a JSON map of offsets by partition.

The driver reads file footers only, each once. A batch's offsets of one partition are split
into ranges of at most ``rowsPerTask`` offsets, so that a hot partition is many tasks; a task
opens the files whose range it meets and pushes its bounds down to their row groups.

Defined cases: a folder that does not exist yet is a topic without partitions; a partition
that the map does not name, or that appears later, is read from its first offset; -1 in the
map means the latest offset and -2 the earliest; gaps in the offsets are fine; null keys and
values are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "topic string, partition int, offset bigint, key string, value string"
LATEST, EARLIEST = -1, -2
ROWS_PER_TASK = 1_000_000
_PLACE = re.compile(r"/topic=([^/]+)/partition=(\d+)/[^/_.][^/]*$")


def write_records(records: DataFrame, path: str) -> None:
    """Append ``records(topic, partition, offset, key, value)`` to the topics' folders."""
    (records.select("topic", "partition", "offset", "key", "value")
     .repartitionByRange("topic", "partition", "offset")
     .sortWithinPartitions("topic", "partition", "offset")
     .write.mode("append").partitionBy("topic", "partition").parquet(path))


class Range(InputPartition):
    """Offsets ``start`` to ``end``, end exclusive, of one partition, and its files."""

    def __init__(self, partition: int, start: int, end: int, files: list[str]):
        self.partition, self.start, self.end, self.files = partition, start, end, files


class TopicReader(DataSourceStreamReader):
    def __init__(self, path: str, topic: str, starting: str, rows_per_task: int):
        self.path, self.topic, self.starting, self.rows = path, topic, starting, rows_per_task
        #: (first, last) offset of every file seen so far, by partition
        self.files: dict[int, dict[str, tuple[int, int]]] = {}

    def _store(self) -> tuple[pafs.FileSystem, str]:
        if re.match(r"^\w+:/", self.path):
            return pafs.FileSystem.from_uri(self.path)
        return pafs.LocalFileSystem(), self.path

    def _scan(self) -> None:
        """Take in the files that came since the last look."""
        store, root = self._store()
        at = pafs.FileSelector(f"{root}/topic={self.topic}", recursive=True, allow_not_found=True)
        for info in store.get_file_info(at):
            found = _PLACE.search(info.path) if info.type == pafs.FileType.File else None
            known = self.files.setdefault(int(found[2]), {}) if found else None
            if found is None or info.path in known:
                continue
            footer = pq.read_metadata(info.path, filesystem=store)
            column = footer.schema.names.index("offset")
            bounds = [footer.row_group(k).column(column).statistics for k in range(footer.num_row_groups)]
            bounds = [s for s in bounds if s is not None and s.has_min_max]
            if bounds:
                known[info.path] = min(s.min for s in bounds), max(s.max for s in bounds)

    def _ends(self) -> dict[str, int]:
        """Next offset of every partition that has files."""
        return {str(p): max(last for _, last in known.values()) + 1
                for p, known in self.files.items() if known}

    def initialOffset(self) -> dict:
        self._scan()
        ends = self._ends()
        if self.starting == "latest":
            return ends
        if self.starting == "earliest":
            return {p: 0 for p in ends}
        asked = json.loads(self.starting)
        asked = asked.get(self.topic, asked)
        given = {p: int(asked.get(p, EARLIEST)) for p in {*ends, *asked}}
        return {p: {LATEST: ends.get(p, 0), EARLIEST: 0}.get(o, o) for p, o in given.items()}

    def latestOffset(self) -> dict:
        self._scan()
        return self._ends()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self._scan()
        made = []
        for p, stop in end.items():
            files = self.files.get(int(p), {})
            low = start.get(p, 0)
            for at in range(low, stop, self.rows):
                to = min(at + self.rows, stop)
                meets = sorted(f for f, (first, last) in files.items() if first < to and last >= at)
                if meets:
                    made.append(Range(int(p), at, to, meets))
        return made

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = self._store()
        data = ds.dataset(partition.files, filesystem=store, format="parquet")
        wanted = (ds.field("offset") >= partition.start) & (ds.field("offset") < partition.end)
        for batch in data.to_batches(columns=["offset", "key", "value"], filter=wanted):
            if batch.num_rows:
                topic = pa.array([self.topic] * batch.num_rows, pa.string())
                number = pa.array([partition.partition] * batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [topic, number, *(c.cast(t) for c, t in zip(
                        batch.columns, (pa.int64(), pa.string(), pa.string())))],
                    ["topic", "partition", "offset", "key", "value"])


class TopicSource(DataSource):
    """``readStream.format("topic_log")`` with the options path, subscribe,
    startingOffsets (latest, earliest or JSON) and rowsPerTask."""

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:
        o = self.options
        return TopicReader(o["path"].rstrip("/"), o["subscribe"], o.get("startingOffsets", "latest"),
                           int(o.get("rowsPerTask", ROWS_PER_TASK)))


def topic_stream(spark: SparkSession, path: str, topic: str, starting_offsets: str | dict = "latest",
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Records of one topic; ``starting_offsets`` holds for a first start only."""
    spark.dataSource.register(TopicSource)
    if isinstance(starting_offsets, dict):
        starting_offsets = json.dumps(starting_offsets)
    return (spark.readStream.format("topic_log").option("subscribe", topic)
            .option("startingOffsets", starting_offsets).option("rowsPerTask", rows_per_task)
            .load(path))


def event_records(events: DataFrame, topic: str, partitions: int = 3) -> DataFrame:
    """Events as records of a topic: dealt over partitions by id, the offset grows with it."""
    at = F.col("event_id")
    return events.select(
        F.lit(topic).alias("topic"), (at % partitions).cast("int").alias("partition"),
        F.floor(at / partitions).cast("bigint").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "event_type", F.col("value").alias("value"))).alias("value"))
