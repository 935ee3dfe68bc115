"""Session construction and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "rillet", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. Cluster deployments pass their own master/conf."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset on a
    ``local`` master (tests) a private folder is created and registered; on a
    cluster an unset folder is an error, since a machine-local folder would be
    lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="rillet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = os.path.join(root, "rillet", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def _at(spark: SparkSession, path: str):
    """(file system, path) of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a scratch folder; whether there was one."""
    files, at = _at(spark, path)
    return files.delete(at, True)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below ``paths``."""
    return sum(files.getContentSummary(at).getLength() for files, at in (_at(spark, p) for p in paths))


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this process asked for; how many there were. For the
    end of an application, when no result that reads them is needed any more."""
    gone = 0
    while _SCRATCH:
        gone += drop_path(spark, _SCRATCH.pop())
    _STORED.clear()
    return gone


#: Bytes of input whose rows one pass of a large write moves.
PASS_BYTES = 256 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def conf_set(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """``wanted`` settings hold inside."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_shuffle_left(spark: SparkSession):
    """The shuffle files of a job that runs inside go when it ends, instead of when the
    driver next collects garbage."""
    return conf_set(spark, {CLEANUP: "true"})


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of plans that nothing refers to any more go now: those of a stream's
    batches hang on what the batch persisted, and the driver may not collect garbage for long."""
    gc.collect()
    spark._jvm.System.gc()


def passes(spark: SparkSession, *paths: str) -> int:
    """Passes in which a table derived from ``paths`` is written, so that the shuffle files
    that stand on disk at a time do not grow with the input."""
    return max(1, -(-stored_bytes(spark, *paths) // PASS_BYTES))


def in_pass(key: str, part: int, parts: int) -> Column:
    """Rows of pass ``part``: equal keys come in one pass, those without a key in one, too."""
    return F.pmod(F.xxhash64(F.col(key).try_cast("bigint")), F.lit(parts)) == part


_STORED: dict[tuple[str, str, str, tuple], str] = {}


def state_of_input(spark: SparkSession, source: str) -> tuple:
    """What tells whether the files below ``source`` are still the same: their number and a
    sum over paths, sizes and times. Only the listing is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(source))
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count(F.lit(1)), F.sum(mark)).first())


def stored_once(spark: SparkSession, name: str, source: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from the files below ``source``: ``write(path)`` fills it at
    the first call of an application, in the shared folder; later calls give the same path
    as long as these files are the same, and a new one once they changed. No shuffle file of
    the writing is left."""
    with no_shuffle_left(spark):
        known = (spark.sparkContext.applicationId, name, source, state_of_input(spark, source))
        if known not in _STORED:
            path = scratch_path(spark, name)
            write(path)
            _STORED[known] = path
    return _STORED[known]
