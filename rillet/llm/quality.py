"""Quality rules: base word statistics and compression bands.

A text's zstandard ratio (bytes over compressed bytes) must lie in the band of its
length, and so must the ratios of its fixed chunks, but for a small share of bytes.
Repetitive text lies above a band, incompressible text (keys, encoded blobs) below.

Words are the runs of bytes outside 0x20 and 0x09-0x0D. Defined cases: a null text has
no word, fails the base rules and is not kept, like an empty one; each repeated row
gets its own row; an empty table gives an empty result; columns other than ``doc_id``
and ``text`` are ignored. Texts are measured whole, whatever their length.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import codepoints, text_slices

#: (bytes below, least ratio, greatest ratio) of whole texts.
BANDS = ((100, 0.6, 1.7), (200, 0.8, 1.8), (400, 1.05, 2.0), (800, 1.2, 2.2),
         (1_600, 1.35, 2.4), (4_000, 1.45, 2.6), (16_000, 1.55, 2.9),
         (float("inf"), 1.6, 3.4))
#: Fixed chunks of texts longer than one chunk, their band, and the share of a text's
#: bytes that may lie in chunks outside it.
CHUNK = 4096
CHUNK_BAND = (1.4, 2.8)
CHUNK_SHARE = 0.25
LEVEL = 3
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\r\x0b\x0c"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
SCHEMA = ("n_bytes bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, doc_ratio double, least_chunk_ratio double, "
          "greatest_chunk_ratio double, odd_chunk_share double")


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    grams = list(zip(*(words[k:] for k in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    seen, total, end = Counter(grams), 0, 0
    for at, gram in enumerate(grams):
        if seen[gram] > 1:
            total += at + window - max(at, end)
            end = at + window
    return total


def measure(text: bytes, squeeze, chunk: int = CHUNK, band=CHUNK_BAND) -> tuple:
    """The measures of one text; ``squeeze`` compresses bytes."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    ratio = lambda b: len(b) / len(squeeze(b))
    chunks = [text[k:k + chunk] for k in range(0, len(text), chunk)] if len(text) > chunk else []
    if chunks and len(chunks[-1]) < chunk // 2:  # too short for the chunks' band
        chunks.pop()
    ratios = [(ratio(c), len(c)) for c in chunks]
    odd = sum(n for r, n in ratios if not band[0] <= r <= band[1])
    return (len(words), codepoints(text.translate(None, SPACE)),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeat_words(words), ratio(text), min((r for r, _ in ratios), default=None),
            max((r for r, _ in ratios), default=None),
            odd / sum(n for _, n in ratios) if ratios else 0.0)


def _measure(batches, chunk, band, level):
    """Every column but the text as it came, then the measures."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    kinds = [pa.int64()] * 6 + [pa.float64()] * 4
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for part, texts in text_slices(batches):
        cols = zip(*((len(t), *measure(t, squeeze, chunk, band)) for t in texts))
        other = part.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*other.columns, *(pa.array(c, k) for c, k in zip(cols, kinds))],
            [*other.schema.names, *names])


def _in_band(bands):
    """The ratio lies in its length's band; lengths are bytes of UTF-8."""
    verdict, length = None, F.col("n_bytes")
    for below, least, most in bands:
        holds = F.col("doc_ratio").between(least, most)
        if below == float("inf"):
            return holds if verdict is None else verdict.otherwise(holds)
        verdict = (F if verdict is None else verdict).when(length < below, holds)
    return verdict.otherwise(F.lit(True))


def measured(docs: DataFrame, chunk: int = CHUNK, chunk_band=CHUNK_BAND,
             level: int = LEVEL) -> DataFrame:
    """``docs`` without ``text``, with the measures added. Its other columns must not
    have the measures' names."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in docs.schema if f.name != "text")
    return docs.mapInArrow(partial(_measure, chunk=chunk, band=chunk_band, level=level),
                           f"{kept}, {SCHEMA}")


def _judged(rows: DataFrame, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND,
            chunk_share: float = CHUNK_SHARE, level: int = LEVEL) -> DataFrame:
    rows = measured(rows, chunk, chunk_band, level)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (rows.withColumn("base_failed", failed)
            .withColumn("in_band", _in_band(bands) & (F.col("odd_chunk_share") <= chunk_share))
            .withColumn("kept", ~F.col("base_failed") & F.col("in_band")))


def quality(docs: DataFrame, **limits) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: its statistics and ratios,
    ``base_failed``, ``in_band`` and ``kept``. ``limits`` are those of the module."""
    return _judged(docs.select("doc_id", "text"), **limits)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` alone. Other columns
    travel in one struct, so that no name can clash with a measure."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return _judged(docs.select("text", row)).where("kept").select("row.*")
