"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a tiled
exact comparison.

Fingerprints are dealt into tiles by the bit counts of their four 16-bit quarters.
Two fingerprints within the radius differ by at most the radius in the sum of these
counts' differences, so a pair of tiles beyond that is skipped whole. The pairs of
tiles left are compared exactly, with numpy exclusive-or and bit counts.

Defined cases: null and empty texts, and texts without a word, have fingerprint zero
and link like any other. Repeated rows each give a row. A null id is carried; it is
never the smallest id of a component unless it has no other. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import stored, text_slices
from rillet.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints of a tile that are compared as one block.
BLOCK = 2048
#: A key with more than one HOT-th of the rows is joined by broadcast.
HOT = 1000
#: Pairs that one numpy call compares.
CELLS = 1 << 21
_QUARTERS, _BASE = 4, 17


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text: a bit is 1 if set in over half of its shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(g, SEED) for g in grams), np.uint64)
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, shingle):
    for part, texts in text_slices(batches):
        prints = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        other = part.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*other.columns, pa.array(prints.view(np.int64))], [*other.schema.names, "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text, with ``fp``: the fingerprint as a signed long."""
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, "
                   for f in docs.schema if f.name != "text")
    return docs.mapInArrow(partial(_fingerprints, shingle=shingle), f"{kept}fp bigint")


def _tile():
    """Tile number from the bit counts of the fingerprint's quarters."""
    return sum((F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF)))
                * _BASE ** q for q in range(_QUARTERS)), F.lit(0)).cast("int")


def _counts(tile: int) -> tuple[int, ...]:
    return tuple(tile // _BASE ** q % _BASE for q in range(_QUARTERS))


def _near(tile: int, sizes: dict[int, int], radius: int) -> list[int]:
    """Occupied tiles below ``tile`` whose bit counts are within the radius."""
    found = []

    def walk(q: int, code: int, left: int) -> None:
        if q < 0:
            if code < tile and code in sizes:
                found.append(code)
            return
        own = tile // _BASE ** q % _BASE
        for c in range(max(0, own - left), min(_BASE - 1, own + left) + 1):
            walk(q - 1, code + c * _BASE ** q, left - abs(c - own))

    walk(_QUARTERS - 1, 0, radius)
    return found


def _visits(batches, sizes, radius):
    """Send each block of a tile home and, as a visitor, to the blocks it must meet."""
    for batch in batches:
        homes, visitor, lists, rows = [], [], [], 0
        for r in batch.to_pylist():
            tile, block = r["tile"], r["block"]
            goals = [(tile, b) for b in range(block + 1)]
            goals += [(t, b) for t in _near(tile, sizes, radius) for b in range(sizes[t])]
            for t, b in goals:
                homes.append((t << 32) + b)
                visitor.append((t, b) != (tile, block))
                lists.append(r["fps"])
                rows += len(r["fps"])
            if rows > 1 << 18:
                yield _visit_batch(homes, visitor, lists)
                homes, visitor, lists, rows = [], [], [], 0
        if homes:
            yield _visit_batch(homes, visitor, lists)


def _visit_batch(homes, visitor, lists):
    return pa.RecordBatch.from_arrays(
        [pa.array(homes, pa.int64()), pa.array(visitor, pa.bool_()),
         pa.array(lists, pa.list_(pa.int64()))], ["home", "visitor", "fps"])


class _Forest:
    """Links found at one home that join what was not joined yet."""

    def __init__(self, own: np.ndarray):
        self.own, self.up = own, list(range(len(own)))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def meet(self, others: np.ndarray, radius: int, inside: bool):
        step = max(1, CELLS // max(1, len(self.own)))
        for at in range(0, len(others), step):
            part = others[at:at + step]
            close = np.bitwise_count(part[:, None] ^ self.own[None, :]) <= radius
            joined: dict[int, int] = {}
            for j, i in zip(*np.nonzero(close)):
                j, i = int(j), int(i)
                if inside:
                    a, b = self.root(at + j), self.root(i)
                    if a == b:
                        continue
                    self.up[a] = b
                elif j in joined:
                    a, b = self.root(joined[j]), self.root(i)
                    if a == b:
                        continue
                    self.up[a] = b
                else:
                    joined[j] = i
                yield int(part[j]), int(self.own[i])


def _compare(batches, radius):
    home = forest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        homes = batch.column(0).to_numpy()
        guests = batch.column(1).to_numpy(zero_copy_only=False)
        fps, values = batch.column(2), batch.column(2).values.to_numpy().view(np.uint64)
        ends = fps.offsets.to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(np.diff(homes)) + 1, [len(homes)]])
        links: list[tuple[int, int]] = []
        for lo, hi in zip(starts[:-1], starts[1:]):
            if homes[lo] != home:
                home, forest = homes[lo], None
            if not guests[lo]:
                forest = _Forest(values[ends[lo]:ends[lo + 1]].copy())
                links += forest.meet(forest.own, radius, True)
                lo += 1
            if lo < hi and forest is not None:
                links += forest.meet(values[ends[lo]:ends[hi]], radius, False)
        if links:
            a = np.array(links, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: links that connect exactly the distinct fingerprints ``fp`` which
    pairs within the radius connect. A home gives a spanning forest, not all pairs."""
    tiled = prints.select("fp", _tile().alias("tile"))
    # at most 17^4 rows, whatever the input
    sizes = {r["tile"]: -(-r["n"] // BLOCK)
             for r in tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = prints.sparkSession
    wide = F.broadcast(spark.createDataFrame(
        [(t, n) for t, n in sizes.items() if n > 1], "tile int, blocks int"))
    blocks = (tiled.join(wide, "tile", "left")
              .groupBy("tile", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))
                       .cast("int").alias("block"))
              .agg(F.collect_list("fp").alias("fps")))
    visits = blocks.mapInArrow(partial(_visits, sizes=sizes, radius=radius),
                               "home bigint, visitor boolean, fps array<bigint>")
    return (visits.repartition("home").sortWithinPartitions("home", "visitor")
            .mapInArrow(partial(_compare, radius=radius), "a bigint, b bigint"))


def _joined(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of the stored ``facts(key, n, ...)``, n being the number of
    rows of a key. Keys of over one ``HOT``-th of the rows, fewer than ``HOT`` in number, meet
    their rows by broadcast, so that no task gets more than one ``HOT``-th by its key."""
    total = facts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT > total
    hot = F.broadcast(facts.where(is_hot).drop("n"))
    cool = rows.join(hot.select(key), key, "left_anti").join(facts.where(~is_hot).drop("n"), key)
    return rows.join(hot, key).unionByName(cool)


def _classified(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """``docs`` without its text, with ``fp``, its component's smallest fingerprint
    ``root`` and smallest id ``component_id``."""
    prints = stored(fingerprints(docs, shingle), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    linked = stored(components(links(nodes.select("fp"), radius)).toDF("fp", "root"), "roots")
    least = stored(nodes.join(linked, "fp").groupBy("root").agg(
        F.min("first_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "least")
    classes = nodes.join(_joined(linked, least, "root"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("least_id"))
        .alias("component_id"), "n")
    return _joined(prints, stored(classes, "classes"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
                    ) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs(doc_id, text)``."""
    return _classified(docs.select("doc_id", "text"), shingle, radius).select(
        "doc_id", "fp", "component_id")


def survivors(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, a null id last;
    of several texts with this id the one with the least digest; of equal rows any."""
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                               F.coalesce(F.concat(F.lit("text:"), "text"), F.lit("null"))))
    rows = docs.select(digest.alias("digest"), F.struct(
        *(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    found = _classified(docs.select("doc_id", "text", digest.alias("digest")), shingle, radius)
    first = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("first"))
    stay = first.select(F.col("first.digest").alias("digest"))
    return (rows.join(stay, "digest", "left_semi").dropDuplicates(["digest"])
            .select("row.*"))


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
