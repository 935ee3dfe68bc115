"""Substring deduplication by content-defined chunking.

A gear hash rolls over a text's bytes: a byte's table entry is added to the shifted
hash, so the hash at a place depends on the last ``GEAR`` bytes alone. A chunk ends
where this hash is the maximum within ``REACH`` bytes on either side and has no equal
before it. Periodic text has no such place; long stretches without one are cut at equal
maxima, ``REACH`` bytes apart or more. Cuts therefore depend on nothing but the bytes around them: after an
insertion the cuts fall in the same places of the text again at once.

A span is a chunk with as many chunks after it as give ``LEAST_BYTES``; its digest (96
bits) stands for these variable chunks. A digest found in two or more documents marks its
spans as repeated wherever they are. Overlapping repeated spans of a document join into
stretches; those of at least ``LEAST_CHARS`` code points are the result. The first place of
a digest (smallest id, then offset) is the one to keep: a stretch is cut at the bounds of
its first places into runs that are ``kept`` (first places) and runs that go (the rest).
So every digest stays whole in its first place. A run of a longer stretch may be short.

A document is an id and a text: ``text_key`` (a 64-bit hash of the text) tells texts of one
id apart, so each text has its own runs and loses its own cuts alone. Defined cases: repeated
rows of one id and text are one document and no copies; every row of a null id is a document
of its own, by a number in place of the text's hash, and comes after all others; null and
empty texts, and texts too short for a span, have no run; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillet.llm.common import stored, text_slices

GEAR = 16
REACH = 24
LEAST_BYTES = 64
LEAST_CHARS = 100
#: Stretches without a cut of over so many times the reach are cut at equal maxima too.
LONG_GAP = 8
SEED = 42
#: The gear table: 256 numbers by rule.
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([b]), SEED) for b in range(256)], np.uint64)


def gear(data: np.ndarray) -> np.ndarray:
    """Hash at each byte over the last ``GEAR`` bytes; sums of doubled spans."""
    h, span = _TABLE[data], 1
    while span < GEAR:
        more = h.copy()
        more[span:] += h[:-span] << np.uint64(span)
        h, span = more, span * 2
    # the high bits hold what the low bits of the entries would leave too regular
    return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)


def cuts(text: bytes, reach: int = REACH) -> np.ndarray:
    """Offsets in bytes where chunks end, between code points, without 0 and the end."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < 2 * reach:
        return np.zeros(0, np.int64)
    h = gear(data)
    # a cut after byte i needs a code point's start at i + 1
    h[:-1][(data[1:] & 0xC0) == 0x80] = 0
    most = h.copy()  # maximum of the next 2^k values, then of the reach
    span = 1
    while span * 2 <= reach:
        most[:-span] = np.maximum(most[:-span], most[span:])
        span *= 2
    ahead = np.zeros_like(h)  # maximum of h[i+1 .. i+reach]
    n = len(h)
    ahead[:n - reach] = np.maximum(most[1:n - reach + 1], most[reach - span + 1:n - span + 1])
    behind = np.full_like(h, np.iinfo(np.uint64).max)
    behind[reach:] = np.maximum(most[:n - reach], most[reach - span:n - span])
    inside = np.zeros(n, bool)
    inside[GEAR + reach:n - reach] = True
    soft = np.flatnonzero(inside & (h >= behind) & (h >= ahead) & (h > 0))
    at = soft[h[soft] > behind[soft]]
    edges = np.concatenate([[0], at, [n]])
    wide = np.flatnonzero(np.diff(edges) > LONG_GAP * reach)
    more = []
    for a, b in zip(edges[wide], edges[wide + 1]):
        last = a
        for k in soft[np.searchsorted(soft, a, "right"):np.searchsorted(soft, b)].tolist():
            if k - last >= reach:
                more.append(k)
                last = k
    return np.sort(np.concatenate([at, np.array(more, np.int64)])) + 1


def spans(text: bytes, reach: int = REACH, least: int = LEAST_BYTES
          ) -> list[tuple[int, int]]:
    """(start, end) in bytes of each chunk with as many chunks after it as it needs."""
    at = cuts(text, reach)
    stop = np.searchsorted(at, at + least)
    whole = stop < len(at)
    return list(zip(at[whole].tolist(), at[stop[whole]].tolist()))


def _digests(batches, reach, least):
    digest = xxhash.xxh3_128_digest
    for part, texts in text_slices(batches):
        owner, starts, ends, found = [], [], [], []
        for k, text in enumerate(texts):
            here = spans(text, reach, least)
            if here:
                found += [digest(text[a:b]) for a, b in here]
                place = np.array(here)
                if not text.isascii():  # offsets in code points
                    heads = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                    place = np.concatenate([[0], heads])[place]
                owner.append(np.full(len(here), k))
                starts.append(place[:, 0])
                ends.append(place[:, 1])
        if found:
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(pa.array(np.concatenate(owner))) for c in (0, 1)]
                + [pa.array(np.concatenate(starts).astype(np.int32)),
                 pa.array(np.concatenate(ends).astype(np.int32)),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1].astype(np.int32))],
                ["doc_id", "text_key", "start", "end", "d1", "d2"])


def digests(docs: DataFrame, reach: int = REACH, least: int = LEAST_BYTES) -> DataFrame:
    """``(doc_id, text_key, start, end, d1, d2)`` per span of ``docs(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("text"))
    return docs.select("doc_id", key.alias("text_key"), "text").mapInArrow(
        partial(_digests, reach=reach, least=least),
        f"doc_id {kind}, text_key bigint, start int, end int, d1 bigint, d2 int")


def repeated_runs(docs: DataFrame, reach: int = REACH, least: int = LEAST_BYTES,
                  least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(doc_id, text_key, start, end, n_chars, n_spans, first_doc_id, kept)`` per repeated
    run; offsets are code points, end exclusive."""
    found = stored(digests(docs, reach, least), "spans")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "start")
    known = found.groupBy("d1", "d2").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).where(
        "not (first.doc_id <=> last.doc_id and first.text_key = last.text_key)").select("d1", "d2", "first")
    # both sides of the join are scans, so that AQE can split a digest found everywhere
    marked = found.join(stored(known, "repeated"), ["d1", "d2"]).select(
        "doc_id", "text_key", "start", "end", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.text_key").alias("first_key"), F.col("first.start").alias("first_start"))
    own = (F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_key") == F.col("first_key"))
           & (F.col("start") == F.col("first_start")))
    order = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    # a repeated row of one id and text has each span twice
    marked = marked.withColumn("again", F.col("start") == F.lag("start").over(order)).where(
        "again is null or not again")
    opens = F.coalesce(F.col("start") > F.max("end").over(past), F.lit(True)).cast("int")
    # starts and ends rise together: the own spans around a span leave one piece of it
    low = F.greatest("start", F.max(F.when(F.col("own"), F.col("end"))).over(past))
    high = F.least("end", F.expr(
        "lead(if(own, start, null)) ignore nulls over (partition by doc_id, text_key order by start, end)"))
    pieces = (marked.withColumn("own", own).withColumn("opens", opens)
              .withColumn("run", F.sum("opens").over(order))
              .withColumn("low", F.when(F.col("own"), F.col("start")).otherwise(low))
              .withColumn("high", F.when(F.col("own"), F.col("end")).otherwise(high))
              .where("low < high"))
    turns = F.coalesce((F.col("low") > F.max("high").over(past))
                       | (F.col("own") != F.lag("own").over(order)), F.lit(True)).cast("int")
    parts = (pieces.withColumn("turns", turns).withColumn("part", F.sum("turns").over(order))
             .groupBy("doc_id", "text_key", "run", "part").agg(
                 F.min("low").alias("start"), F.max("high").alias("end"),
                 F.count(F.lit(1)).alias("n_spans"),
                 F.min("first_doc_id").alias("first_doc_id"), F.min("own").alias("kept")))
    whole = Window.partitionBy("doc_id", "text_key", "run")
    long = F.max("end").over(whole) - F.min("start").over(whole) >= least_chars
    return parts.withColumn("long", long).where("long").withColumn(
        "n_chars", F.col("end") - F.col("start")).select(
        "doc_id", "text_key", "start", "end", "n_chars", "n_spans", "first_doc_id", "kept")


def deduplicate(docs: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """``(doc_id, text)`` without the runs that are not kept; rows of a null id stay whole,
    since nothing names them again."""
    runs = repeated_runs(docs) if runs is None else runs
    gone = runs.where("not kept and doc_id is not null").groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    ends = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["end"]))
    pieces = F.zip_with(F.slice(ends, 1, F.size("cuts")), F.col("cuts"), lambda e, c: F.substring(
        F.col("text"), e + 1, c["start"] - e))
    rest = F.substring(F.col("text"), F.element_at(ends, -1) + 1, F.length("text"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.join(gone, ["doc_id", "text_key"], "left").select(
        "doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(
            F.concat(F.array_join(pieces, ""), rest)).alias("text"))
