"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.session import scratch_path

#: Bytes of text that a Python worker holds at once, long single texts apart.
SLICE_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below ``spark.checkpoint.dir`` and
    read it back, so that a lost executor costs no recomputation before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text"
                ) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into slices of about ``SLICE_BYTES`` and give each with
    its texts as UTF-8 bytes (null: empty). A longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
            part = batch.slice(start, stop - start)
            texts = part.column(part.schema.get_field_index(column)).cast(pa.binary())
            yield part, [t or b"" for t in texts.to_pylist()]
            start = stop


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers by byte planes, so that like bytes stand together, compressed."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack_numbers(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def codepoints(text: bytes) -> int:
    """Unicode code points of UTF-8 bytes."""
    return len(text.decode("utf-8", "replace"))


def doc_crc(doc_id: str = "doc_id"):
    """crc32 of the id as text, as the folds of the contracts want it."""
    return F.crc32(F.col(doc_id).cast("string"))


def parts_for(total_bytes: int, per_part: int, least: int = 1) -> int:
    """Partitions so that each holds about ``per_part`` bytes."""
    return max(least, -(-int(total_bytes) // per_part))
